"""tabwright: tabular profiling, preparation and regression as Spark jobs."""

__version__ = "0.1.0"
