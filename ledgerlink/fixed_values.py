"""Names, labels and constants that results must carry as they are.

Nothing here is logic.  Everything that a run may want to change is a parameter
elsewhere and only takes its default from this module.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# Columns every source must carry; further columns are tolerated.
REQUIRED_COLUMNS = {
    "erp": ("product_id", "onsale_web", "price", "stock_quantity", "stock_status"),
    "liaison": ("product_id", "id_web"),
    "web": ("sku", "total_sales", "post_title", "post_type", "post_modified", "guid"),
}

# Columns that hold identifiers, in whichever source they occur.
IDENTIFIER_COLUMNS = ("product_id", "id_web", "sku")

# Post types of the web system that describe a product.
PRODUCT_POST_TYPES = ("product", "attachment")



@dataclass(frozen=True)
class FieldRule:
    """What the rows of a table need: columns that are present, that hold text, that
    are finite numbers, that have one of the listed values, and that are equal."""

    present: tuple[str, ...] = ()
    filled: tuple[str, ...] = ()
    finite: tuple[str, ...] = ()
    one_of: tuple[tuple[str, tuple[str, ...]], ...] = ()
    equal: tuple[tuple[str, str], ...] = ()


FIELD_RULES = {
    "product": FieldRule(present=("product_id",), finite=("price",)),
    "bridge": FieldRule(present=("product_id",)),
    "web": FieldRule(
        present=("total_sales",),
        filled=("post_title", "sku"),
        one_of=(("post_type", PRODUCT_POST_TYPES),),
    ),
    "merged": FieldRule(
        present=("product_id", "total_sales"),
        filled=("id_web", "post_title", "sku"),
        finite=("price",),
        equal=(("id_web", "sku"),),
    ),
}

# Column order of the stored tables.
MERGED_COLUMNS = (
    "product_id",
    "id_web",
    "sku",
    "post_title",
    "onsale_web",
    "price",
    "stock_quantity",
    "stock_status",
    "total_sales",
    "post_modified",
    "guid",
)
REVENUE_COLUMNS = (
    "product_id",
    "id_web",
    "post_title",
    "price",
    "total_sales",
    "revenue",
)
SEGMENT_COLUMNS = REVENUE_COLUMNS + ("z_score", "category", "wine_type")

# Labels of the two segments.
PREMIUM = "premium"
ORDINARY = "ordinaire"
PREMIUM_TYPE = "millésime"
ORDINARY_TYPE = "ordinaire"

# A value is premium when its z-score is strictly above this.
Z_THRESHOLD = 2.0
# Largest accepted distance between a stored and a recomputed z-score.
Z_TOLERANCE = 1e-9

# Published results of the original business data set; other data sets bring
# their own values in an ``Expected``.
EXPECTED_ROWS = {
    "erp_after_deduplication": 825,
    "liaison_after_deduplication": 825,
    "web_after_cleaning": 1428,
    "web_after_deduplication": 714,
    "merged_count": 714,
}
EXPECTED_TOTAL_REVENUE = Decimal("70568.60")
EXPECTED_PREMIUM = 30

# Validation stages in the order in which they gate a run.
STAGES = ("cleaning", "merge", "revenue", "segmentation")

# Keys, values and file names of the quality report.
REPORT_KEYS = (
    "status", "stage", "generated_at_utc", "metrics", "row_count_tests", "checks",
)
PASSED, FAILED = "passed", "failed"
EXPECTED_TOTAL_METRIC = "expected_total_revenue"
REPORT_FILES = {"all": "quality_report.json"}

# Headers of the revenue report.
REPORT_HEADERS = {
    "product_id": "product_id",
    "id_web": "id_web",
    "post_title": "Produit",
    "price": "Prix unitaire (€)",
    "total_sales": "Quantité vendue",
    "revenue": "Chiffre d'affaires (€)",
}
SUMMARY_HEADERS = {
    "total_revenue": "Chiffre d'affaires total",
    "product_count": "Nombre de produits",
    "bottles_sold": "Unités vendues",
}

# Blanks removed by SQL TRIM in the source system: Unicode category Zs.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)

# Blanks removed around identifiers: the above and all other white space.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0085\u2028\u2029"
) + SPACE_SEPARATORS
