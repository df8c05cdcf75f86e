"""Job options."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed default values.
BATCH_SECONDS = 60
BATCH_MAX_RECORDS = 1000
RECORD_GAP_SECONDS = 30
SUMMARY_GAP_SECONDS = 300
ENSEMBLE_SECONDS = 120
TRANSDUCER_DEPTH_M = 7.0
CORRELATION_THRESHOLD = 64
WATCH_PATTERNS = "*.csv,*.txt,*.hex,*.cnv,*.raw,*.ad2cp,*.tar.gz,*.tgz"
DATASET = "sensordata"


@dataclass(frozen=True)
class ProviderRule:
    """A data provider: how its files are recognised and what it supplies."""

    name: str
    path_pattern: str
    latitude: float | None = None
    longitude: float | None = None
    attributes: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class JobOptions:
    """What one ingest job needs to know; passed whole, never changed in place."""

    campaign_id: str = ""
    platform_id: str = ""
    provider: str = "auto"
    provider_rules: tuple[ProviderRule, ...] = ()
    dataset: str = DATASET
    watch_patterns: str = WATCH_PATTERNS
    batch_seconds: int = BATCH_SECONDS
    batch_max_records: int = BATCH_MAX_RECORDS
    record_gap_seconds: int = RECORD_GAP_SECONDS
    summary_gap_seconds: int = SUMMARY_GAP_SECONDS
    merge_duplicates: bool = False
    #: Data as GeoParquet, in the table ``geo`` instead of ``data``.
    geoparquet: bool = False
