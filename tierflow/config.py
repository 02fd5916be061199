"""Parameters of a layered pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LAYERS = ("source", "bronze", "silver", "gold")

# Time stamps that readers of the layers rely on.
SILVER_TIME = "silver_transform_time"
GOLD_TIME = "gold_model_time"


@dataclass(frozen=True)
class PipelineConfig:
    """Where the layers live and how they are named.

    ``base_uri`` is the common root; ``layer_uris`` overrides single layers, for stores that keep one
    container per layer. ``raw_schema`` lists the raw header names with the types wanted in bronze.

    ``on_rescued`` says what silver does about values that did not fit their type and lie in the rescue
    column: ``fail`` (nothing is lost unseen) or ``keep`` (they stay in bronze only). ``new_columns`` says what bronze
    does about columns of a CSV header that the schema does not name: ``rescue`` them, row by row, or ``add`` them
    to the schema as a new version. ``stream_options`` go to the
    source of the ingestion, such as ``maxBytesPerTrigger`` for a backlog; ``swap=False`` is for stores where a
    rename copies (see `refresh`), ``snapshots=True`` publishes gold tables so that no reader finds one absent.

    ``wide_rows`` has silver compare digests instead of whole rows (see `dedup`), for long rows of which few come twice.

    The last group shapes silver and is empty by default: text columns to normalise, columns that must
    not be null, and expectations as SQL conditions by name, with what to do about a violation: ``warn`` counts it,
    ``drop`` leaves the row out, ``quarantine`` puts it into a table of its own with the rules that it breaks, ``fail``
    ends the run.
    """

    base_uri: str
    raw_schema: T.StructType | None = None
    dataset: str = "streaming"
    source_format: str = "csv"
    catalog: str | None = None
    schemas: dict[str, str] = field(
        default_factory=lambda: {"bronze": "bronze", "silver": "silver", "gold": "gold"}
    )
    layer_uris: dict[str, str] = field(default_factory=dict)
    table_format: str = "parquet"
    checkpoint_version: str = "v1"
    ingestion_time: str = "ingestion_time"
    source_file: str = "source_file"
    rescued: str = "_rescued_data"
    on_rescued: str = "fail"
    new_columns: str = "rescue"
    stream_options: dict[str, str] = field(default_factory=dict)
    swap: bool = True
    snapshots: bool = False
    wide_rows: bool = False
    text_columns: tuple[str, ...] = ()
    text_case: str | None = None
    required_columns: tuple[str, ...] = ()
    expectations: dict[str, str] = field(default_factory=dict)
    on_violation: str = "warn"

    def __post_init__(self) -> None:
        for uri in (self.base_uri, *self.layer_uris.values()):
            if not uri or not uri.strip() or "<" in uri:
                raise ValueError(f"storage location is not set: {uri!r}")
        if not self.dataset.strip():
            raise ValueError("dataset name is empty")
        if self.on_rescued not in ("fail", "keep"):
            raise ValueError(f"on_rescued must be 'fail' or 'keep', not {self.on_rescued!r}")
        if self.new_columns not in ("rescue", "add"):
            raise ValueError(f"new_columns must be 'rescue' or 'add', not {self.new_columns!r}")
        if self.on_violation not in ("warn", "drop", "quarantine", "fail"):
            raise ValueError(f"on_violation must be warn, drop, quarantine or fail, not {self.on_violation!r}")
        unknown = set(self.layer_uris) - set(LAYERS)
        if unknown:
            raise ValueError(f"unknown layers {sorted(unknown)}; expected {LAYERS}")

    @classmethod
    def for_storage_account(
        cls, account: str, containers: dict[str, str] | None = None, **kwargs
    ) -> PipelineConfig:
        """One ``abfss://container@account`` root per layer, by default a container of its name."""
        if not account or not account.strip() or "<" in account:
            raise ValueError(f"storage account is not set: {account!r}")
        names = {layer: layer for layer in LAYERS} | (containers or {})
        uris = {
            layer: f"abfss://{name.strip()}@{account.strip()}.dfs.core.windows.net"
            for layer, name in names.items()
        }
        return cls(base_uri=uris["bronze"], layer_uris=uris, **kwargs)
