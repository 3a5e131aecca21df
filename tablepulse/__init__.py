"""tablepulse: table health profiling as Spark DataFrame operators.

Every operator takes DataFrames and returns a lazy DataFrame built from
built-in Spark expressions. Nothing is collected to the driver; results are
written by the caller (see ``tablepulse.sinks``).
"""

from tablepulse.functions.partitioning import Partitioning

__all__ = ["Partitioning"]
__version__ = "0.1.0"
