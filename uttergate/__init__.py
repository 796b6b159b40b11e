"""Quality gate for audio-text corpora on Spark."""

from uttergate.config import GateConfig
from uttergate.functions.text import with_normalized_text
from uttergate.operators.audio import validate_paths, with_audio
from uttergate.operators.split import rejected, train_ready
from uttergate.plans.pipeline import publish_gate, run_gate
from uttergate.plans.verdict import verdict
from uttergate.sources.manifest import published
from uttergate.sources.utterances import column_contract, scan_csv, scan_parquet

__all__ = [
    "GateConfig",
    "column_contract",
    "publish_gate",
    "published",
    "rejected",
    "run_gate",
    "scan_csv",
    "scan_parquet",
    "train_ready",
    "validate_paths",
    "verdict",
    "with_audio",
    "with_normalized_text",
]
