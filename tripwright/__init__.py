"""tripwright: Spark-native cleaning, modelling and analysis of vehicle trips.

Sub-packages
------------
sources    text / CSV / Parquet / GeoJSON readers and the events-derived fixtures
sinks      CSV and Parquet writers, view registration
functions  column functions (timestamps, haversine, point-in-boundary)
operators  row validation, per-vehicle order-dependent folds, dense ids, comparison
plans      composed plans: cleaning, star / wide model build, named queries
streaming  the row-level cleaning steps applied to a streaming source
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Python workers may not have this package on their path (a cluster, or a driver started from
    another folder). The fold functions and helpers defined here are therefore pickled by value."""
    import sys

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: fall back to importing on workers
        pass


_ship_by_value()
