"""wattline — solar and wind generation analytics on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` (or a column
expression) built from Spark SQL built-ins, so Catalyst sees one logical
plan from the scan to the sink.
"""

from wattline.config import Defaults, DEFAULTS
from wattline.session import get_spark, prepare_session, checkpoint_dir

__all__ = ["Defaults", "DEFAULTS", "get_spark", "prepare_session", "checkpoint_dir"]
