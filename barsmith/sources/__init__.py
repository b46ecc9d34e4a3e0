from barsmith.sources.bars import (
    epoch_ms_to_timestamp, project_bar, read_bars, read_landed, read_raw_layer, stage_bars, stage_landed,
)
from barsmith.sources.registry import BENCHMARKS, TICKERS, raw_table_name
from barsmith.sources.schema import BAR_SCHEMA

__all__ = [
    "BAR_SCHEMA", "BENCHMARKS", "TICKERS", "epoch_ms_to_timestamp", "project_bar", "raw_table_name",
    "read_bars", "read_landed", "read_raw_layer", "stage_bars", "stage_landed",
]
