"""The application's configuration file."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

import yaml

from kpiloom.functions.transforms import seconds
from kpiloom.sources.scrape import COLLECTORS, Collector


class ConfigError(ValueError):
    """A configuration that cannot be run."""


@dataclass(frozen=True)
class Config:
    """Where the registry lies, what is collected, and where it goes; times in seconds."""

    schema_dir: str
    collectors: tuple[Collector, ...]
    key_ttl: float = 120.0
    window: float = 30.0
    slide: float = 5.0
    correlate: bool = False
    listen: str = ":8080"
    otlp_endpoint: str | None = None
    otlp_headers: dict[str, str] = field(default_factory=dict)
    otlp_batch: int = 100

    @staticmethod
    def load(path: str | Path) -> Config:
        """Reads YAML: ``schema_dir`` and one collector at least are required, as is an endpoint where OTLP is asked for."""
        try:
            content = yaml.safe_load(Path(path).read_text()) or {}
        except yaml.YAMLError as e:
            raise ConfigError(f"{path}: {e}") from e
        if not content.get("schema_dir"):
            raise ConfigError("schema_dir is required")
        entries = content.get("collectors") or []
        if not entries:
            raise ConfigError("no collectors")
        try:
            collectors = tuple(_collector(e) for e in entries)
        except (KeyError, ValueError) as e:
            raise ConfigError(str(e)) from e
        output, otlp = content.get("output") or {}, (content.get("output") or {}).get("otlp")
        if otlp is not None and not otlp.get("endpoint"):
            raise ConfigError("otlp needs an endpoint")
        windows = content.get("correlator")
        redis = (content.get("store") or {}).get("redis") or {}
        return Config(
            content["schema_dir"], collectors, seconds(redis.get("key_ttl", "120s")),
            seconds((windows or {}).get("window_size", "30s")), seconds((windows or {}).get("eval_interval", "5s")), windows is not None,
            (output.get("prometheus") or {}).get("listen") or ":8080", otlp and otlp["endpoint"], dict((otlp or {}).get("headers") or {}), int((otlp or {}).get("batch_size") or 100),
        )


def _collector(entry: dict) -> Collector:
    extra = dict(entry.get("extra") or {})
    options = {"endpoint": entry.get("endpoint", ""), "interval": entry.get("interval", "15s"), "extra": extra}
    if "gnmi_paths" in extra:
        options["paths"] = tuple(extra["gnmi_paths"])
    return COLLECTORS.get(entry["name"], **options)
