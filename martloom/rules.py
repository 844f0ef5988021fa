"""Business lists. Every job takes them as a parameter; these are the defaults."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


# They must equal the mart's own codes for results to match.
@dataclass(frozen=True)
class Rules:
    material_type: str = "Z31"
    material_type_ids: tuple[int, ...] = (1, 8)
    packaging: tuple[str, ...] = ("NR", "RB")
    post_mix_group: str = "PostMix"
    excluded_groups: tuple[int, ...] = (-2, 131, 132, 134, 139, 340, 345)
    scorecard_excluded_groups: tuple[int, ...] = (-2, 131)
    excluded_reason_prefix: str = "6"
    sale_reason: str = ""
    tax_bill: str = "TaxInv"
    excluded_shops: tuple[str, ...] = ("CVM", "Employee")
    special_groups: tuple[str, ...] = ("", "Other")
    employee_prefix: str = "E"
    store_type: str = "Customer store"
    sales_offices: tuple[str, ...] = ("Direct Sales", "Presales", "Online", "Post-Mix", "Vending")
    post_mix_flag: str = "Post-Mix"
    next_day_sales_type: str = "PS"
    food_shop: str = "FSR"
    returnable_packaging: str = "RB"
    cooler_asset: str = "ตู้แช่"
    cooler_excluded_brand: str = "F&N"
    cooler_shops: tuple[str, ...] = ("FSR", "Provision", "Other")
    other_brand: str = "Other Brand"
    brand_family: str = "Oishi"
    # column label -> brand description
    brands: Mapping[str, str] = field(default_factory=lambda: {
        "Est": "Est",
        "Crystal": "Crystal",
        "Oishi": "Oishi",
        "OishiChakulza": "Oishi Chakulza",
        "OishiGreenTea": "Oishi Green Tea",
        "Wrangyer": "Wrangyer",
    })

    def bucket(self, brand: Column) -> Column:
        """Named brand, or the collective bucket for all others (also for NULL)."""
        return F.when(brand.isin(*self.brands.values()), brand).otherwise(F.lit(self.other_brand))

    def in_family(self, brand: Column) -> Column:
        return brand.startswith(self.brand_family)


DEFAULT_RULES = Rules()
