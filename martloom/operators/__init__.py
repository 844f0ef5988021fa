from martloom.operators.geo import assign_region, boundary_cells
from martloom.operators.joins import matched_flag, month_latest, or_join
from martloom.operators.replace import replace_keys, replace_window
from martloom.operators.recon import digested, drill_down, recon

__all__ = [
    "assign_region", "boundary_cells", "digested", "drill_down", "matched_flag", "month_latest", "or_join", "recon",
]
