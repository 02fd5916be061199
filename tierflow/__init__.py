"""tierflow: layered (bronze, silver, gold) analytics on open-source PySpark.

Every operator takes and returns DataFrames and leaves the physical plan to Catalyst.
"""

from tierflow.config import PipelineConfig

__all__ = ["PipelineConfig"]
