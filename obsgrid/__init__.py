"""obsgrid: place-and-time observation analytics on Spark DataFrames.

The main entry points, importable from the package itself.
"""

from obsgrid.operators.kmeans import kmeans_fit, kmeans_ml
from obsgrid.operators.nearest import nearest_station, nearest_to_point
from obsgrid.operators.periods import (avg_month, avg_season, avg_year, in_order, minmax_month, minmax_season,
                                       monthly_history, monthly_history_wide, period_stats, season_midrange)
from obsgrid.operators.profile import location_profile
from obsgrid.operators.quantiles import box_outliers, box_stats, exact_quantiles, median_bisect, median_season
from obsgrid.operators.stations import station_dimension
from obsgrid.plans.reports import cluster_report, map_slice, station_report
from obsgrid.sources.csv_ingest import clean, read_raw, read_station_list, write_station_list
from obsgrid.sources.layouts import finish_upsert, read_layout, upsert_station, upsert_time
from obsgrid.sources.scans import at_instant, month_range, station_years

__version__ = "0.1.0"

__all__ = [
    "avg_month", "avg_season", "avg_year", "at_instant", "box_outliers", "box_stats", "clean", "cluster_report",
    "exact_quantiles", "finish_upsert", "in_order", "kmeans_fit", "kmeans_ml", "location_profile", "map_slice",
    "median_bisect", "median_season", "minmax_month", "minmax_season", "month_range", "monthly_history",
    "monthly_history_wide", "nearest_station", "nearest_to_point", "period_stats", "read_layout", "read_raw", "read_station_list",
    "season_midrange", "station_dimension", "station_report", "station_years", "upsert_station", "upsert_time",
    "write_station_list",
]
