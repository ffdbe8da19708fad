"""SQL the checking database runs beside the Spark queries."""

from oracles.layers import LAYER_ORACLES
from oracles.panels import PANEL_ORACLES
from oracles.reports import REPORT_ORACLES
from oracles.streams import STREAM_ORACLES

ORACLES: dict[str, str] = {
    **LAYER_ORACLES,
    **REPORT_ORACLES,
    **PANEL_ORACLES,
    **STREAM_ORACLES,
}
