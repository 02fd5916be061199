"""Names and locations of the layers."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from tierflow.config import PipelineConfig
from tierflow.storage import FILE_FORMATS, join


@dataclass(frozen=True)
class Layers:
    """Routes a pipeline's tables to paths and to catalog names."""

    config: PipelineConfig

    def path(self, layer: str, *parts: str) -> str:
        """Location of a layer, or of something below it."""
        uris = self.config.layer_uris
        root = uris[layer] if layer in uris else join(self.config.base_uri, layer)
        return join(root, *parts)

    @property
    def source(self) -> str:
        return self.path("source", self.config.dataset)

    @property
    def bronze(self) -> str:
        """The raw table. Plain files get one directory per checkpoint version, see `append_stream`."""
        versioned = self.config.table_format in FILE_FORMATS
        version = self.config.checkpoint_version if versioned else ""
        return self.path("bronze", self.config.dataset, version)

    @property
    def silver(self) -> str:
        return self.path("silver", self.config.dataset)

    @property
    def quarantine(self) -> str:
        """Rows that silver does not take."""
        return self.path("silver", "_quarantine", self.config.dataset)

    def gold(self, model: str) -> str:
        return self.path("gold", model)

    @property
    def schema_store(self) -> str:
        return self.path("bronze", "_schemas", self.config.dataset)

    def checkpoint(self, layer: str = "bronze") -> str:
        """Checkpoint of a layer's stream; a new version in the configuration forces a full re-read."""
        name = f"{self.config.dataset}_{self.config.checkpoint_version}"
        return self.path(layer, "_checkpoints", name)

    def qualify(self, layer: str, table: str) -> str:
        """``catalog.schema.table``, or ``schema.table`` without a catalog."""
        parts = (self.config.catalog, self.config.schemas[layer], table)
        return ".".join(f"`{part}`" for part in parts if part)

    def bootstrap(self, spark: SparkSession) -> str | None:
        """Select the catalog and create one schema per layer; the catalog in use.

        A session that reports no catalog, or cannot use the configured one, is used without one; names are then
        those of a configuration with ``catalog=None``.
        """
        catalog = self._usable_catalog(spark)
        for layer, schema in self.config.schemas.items():
            location = self.path(layer, "_tables").replace("'", "\\'")
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}` LOCATION '{location}'")
        return catalog

    def _usable_catalog(self, spark: SparkSession) -> str | None:
        try:
            if not spark.catalog.currentCatalog() or not self.config.catalog:
                return None
            spark.catalog.setCurrentCatalog(self.config.catalog)
            spark.sql("SHOW SCHEMAS")
        except (PySparkException, Py4JJavaError):  # some failures of the catalog manager come unwrapped
            return None
        return self.config.catalog
