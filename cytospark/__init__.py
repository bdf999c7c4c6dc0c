"""cytospark — analytics over wide numeric event tables grouped into samples, on Spark DataFrames."""
from cytospark.session import get_spark, checkpoint_dir, cut_lineage  # noqa: F401

__version__ = "0.1.0"
