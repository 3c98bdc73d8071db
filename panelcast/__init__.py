"""panelcast: entity-by-month event panels, demand norms, seasonal forecasts
and allocation plans as Spark DataFrame transforms."""

from panelcast.spec import PanelSpec

__all__ = ["PanelSpec"]
