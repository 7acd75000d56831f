"""Parameters of the pipeline, from a nested map."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    raw_dir: str = "data/raw"
    processed_dir: str = "data/processed"
    output_dir: str = "outputs"
    max_speed_kmh: float | None = 200.0
    gap_min: float = 30.0
    min_trip_m: float = 100.0
    min_points: int | None = None
    eps_m: float = 150.0
    min_samples: int = 5
    hdbscan_size: int = 5
    hdbscan_samples: int | None = None
    hdbscan_epsilon_m: float = 0.0
    geohash_precision: int = 7
    stop_window_s: float = 300
    accel_window_s: float = 60
    user_ids: tuple[str, ...] | None = None
    extended: bool = True
    osrm_url: str = "http://localhost:5000"
    gps_accuracy_m: float = 10.0
    radii_cap_m: float = 100.0
    min_support: int = 5
    precision: float = 1e-4
    deviation_m: float = 200.0
    span_m: float = 300.0
    split_s: int | None = None
    user_buckets: int | None = 16


# Where each setting stands in the configuration file.
PLACES = {
    "raw_dir": "paths.raw_data_dir", "processed_dir": "paths.processed_dir", "output_dir": "paths.output_dir", "max_speed_kmh": "features.max_speed_kmh",
    "gap_min": "preprocessing.trip_segmentation_threshold_min", "min_trip_m": "preprocessing.min_trip_distance_m", "eps_m": "stay_point_detection.eps_meters",
    "min_samples": "stay_point_detection.min_samples", "geohash_precision": "stay_point_detection.geohash_precision", "hdbscan_size": "clustering_hdbscan.min_cluster_size",
    "hdbscan_samples": "clustering_hdbscan.min_samples", "hdbscan_epsilon_m": "clustering_hdbscan.cluster_selection_epsilon_m", "stop_window_s": "features.stop_density.window_s",
    "accel_window_s": "features.accel_variability.window_s", "user_ids": "analysis.user_ids", "extended": "modeling.use_extended_features", "osrm_url": "osrm.base_url",
    "gps_accuracy_m": "osrm.gps_accuracy_m", "radii_cap_m": "osrm.radii_cap", "min_support": "routes.matched.min_support", "precision": "routes.matched.spatial_precision",
    "deviation_m": "routes.matched.detour.deviation_threshold_m", "span_m": "routes.matched.detour.min_deviation_span_m",
}


def settings(config: dict, **override) -> Settings:
    """Override before configuration before default; user_ids `all` means everyone."""
    found = {}
    for name, place in PLACES.items():
        at = config
        for part in place.split("."):
            at = at.get(part) if isinstance(at, dict) else None
        if at is not None:
            found[name] = tuple(map(str, at)) if isinstance(at, list) else at
    if found.get("user_ids") == "all":
        found["user_ids"] = None
    return Settings(**(found | override))
