"""Role map: which column plays which part.  Every operator takes column
names as arguments; these maps are only defaults."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    item_id: str = "item_id"
    weight: str = "weight"
    fat: str = "fat_content"
    visibility: str = "visibility"
    item_type: str = "item_type"
    price: str = "price"
    outlet_id: str = "outlet_id"
    year: str = "est_year"
    size: str = "outlet_size"
    location: str = "location_type"
    outlet_type: str = "outlet_type"
    target: str = "sales"
    # derived column names
    outlet_age: str = "outlet_age"
    vis_outlet_mean: str = "visibility_outlet_mean"
    vis_ratio: str = "visibility_ratio"
    price_category: str = "price_category"
    price_visibility: str = "price_visibility"
    weight_visibility: str = "weight_visibility"
    price_weight_ratio: str = "price_weight_ratio"
    # fixed values of the reference pipeline
    reference_year: int = 2013
    fat_mapping: tuple = (("low fat", "Low Fat"), ("LF", "Low Fat"), ("reg", "Regular"))
    size_fallback: str = "Medium"
    missing_token: str = "Missing"
    id_columns: tuple = field(default=())

    @property
    def categoricals(self) -> tuple[str, ...]:
        return (self.fat, self.item_type, self.outlet_id, self.size,
                self.location, self.outlet_type)

    @property
    def excluded(self) -> tuple[str, ...]:
        """Identifier columns plus target: never features."""
        return tuple(self.id_columns) or (self.item_id, self.outlet_id, self.target)


# The driver's fixture view `sales` (see FIXTURES.md).
FIXTURE_ROLES = Roles(id_columns=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                  "l_extendedprice", "fold", "split", "item_id",
                                  "outlet_id", "sales"))

# The reference's own retail schema.
REFERENCE_ROLES = Roles(
    item_id="Item_Identifier", weight="Item_Weight", fat="Item_Fat_Content",
    visibility="Item_Visibility", item_type="Item_Type", price="Item_MRP",
    outlet_id="Outlet_Identifier", year="Outlet_Establishment_Year",
    size="Outlet_Size", location="Outlet_Location_Type", outlet_type="Outlet_Type",
    target="Item_Outlet_Sales", outlet_age="Outlet_Age",
    vis_outlet_mean="Item_Visibility_Outlet_Mean", vis_ratio="Item_Visibility_Ratio",
    price_category="Item_MRP_Category", price_visibility="Item_MRP_Visibility",
    weight_visibility="Weight_Visibility", price_weight_ratio="MRP_Weight_Ratio",
)
