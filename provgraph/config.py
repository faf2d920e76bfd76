"""A run's configuration: one mapping (from YAML or JSON), checked before anything starts; unknown keys fail."""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from provgraph.operators.assemble import Guard
from provgraph.operators.claims import Policy
from provgraph.operators.sinks import Writer

_UNITS = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0}
#: Documents that one run may add by expansion, unless it says otherwise.
MAX_DOCUMENTS = 500
#: Keys of each receiver: required, then optional ones.
RECEIVERS = {"files": (("path",), ("poll",)), "s3": (("bucket",), ("url", "path", "region", "queues", "poll")), "gcs": (("bucket",), ("poll",))}


class ConfigError(ValueError):
    """What is wrong with a configuration, and where."""


@dataclass(frozen=True)
class Config:
    """Paths in the receivers' fixed order, seconds between polls (0: once), the guard's bounds, the policy, the expansion's budget and the sink."""

    paths: tuple[str, ...]
    poll: float
    floor: datetime
    skew: timedelta
    policy: Policy
    max_documents: int
    sink: Writer | None

    def guard(self, now: datetime) -> Guard:
        return Guard(now, self.floor, self.skew)


def seconds(text: str, where: str) -> float:
    """A duration such as 1m30s; none may be negative."""
    parts = re.findall(r"(\d+(?:\.\d+)?)(ms|s|m|h)", text)
    if not parts or "".join(a + b for a, b in parts) != text:
        raise ConfigError(f"{where}: not a duration: {text!r}")
    return sum(float(n) * _UNITS[u] for n, u in parts)


def _part(given: dict, name: str, known: tuple[str, ...]) -> dict:
    part = given.get(name.rsplit(".", 1)[-1]) or {}
    if not isinstance(part, dict):
        raise ConfigError(f"{name}: must be a mapping")
    if unknown := sorted(set(part) - set(known)):
        raise ConfigError(f"{name}: unknown keys {unknown}")
    return part


def _receivers(given: dict) -> tuple[tuple[str, ...], float]:
    found, polls = [], []
    receivers = _part(given, "receivers", tuple(RECEIVERS))
    for kind, (required, optional) in RECEIVERS.items():
        if kind not in receivers:
            continue
        part = _part(receivers, f"receivers.{kind}", required + optional)
        if missing := [k for k in required if not part.get(k)]:
            raise ConfigError(f"receivers.{kind}: needs {missing}")
        if kind == "s3" and part.get("poll") and not part.get("queues"):
            raise ConfigError("receivers.s3: polling needs queues")
        found.append({"files": part.get("path"), "s3": f"s3a://{part.get('bucket')}/{part.get('path', '')}", "gcs": f"gs://{part.get('bucket')}/"}[kind])
        polls.append(seconds(part["poll"], f"receivers.{kind}.poll") if part.get("poll") else 0.0)
    if not found:
        raise ConfigError("receivers: one is needed at least")
    return tuple(found), max(polls)


def parsed(given: dict, environment: dict[str, str] | None = None) -> Config:
    """The checked configuration of a mapping."""
    if unknown := sorted(set(given) - {"receivers", "processors", "sink"}):
        raise ConfigError(f"unknown keys {unknown}")
    environment = os.environ if environment is None else environment
    paths, poll = _receivers(given)
    processors = _part(given, "processors", ("valid_time", "enrich", "expand"))
    times = _part(processors, "processors.valid_time", ("floor", "future_skew"))
    try:
        floor = datetime.fromisoformat(times["floor"]) if times.get("floor") else datetime(2000, 1, 1, tzinfo=UTC)
    except ValueError as error:
        raise ConfigError(f"processors.valid_time.floor: {error}") from error
    skew = timedelta(seconds=seconds(times["future_skew"], "processors.valid_time.future_skew") if times.get("future_skew") else 300)
    enrich = _part(processors, "processors.enrich", ("sources", "eu_only", "hosted"))
    try:
        policy = Policy(tuple(enrich.get("sources") or ()), bool(enrich.get("eu_only", False)), dict(enrich.get("hosted") or {}))
    except ValueError as error:
        raise ConfigError(f"processors.enrich: {error}") from error
    expand = _part(processors, "processors.expand", ("deps_dev", "max_docs"))
    most = expand.get("max_docs", MAX_DOCUMENTS) if expand.get("deps_dev") else 0
    if not isinstance(most, int) or isinstance(most, bool) or most < 0:
        raise ConfigError("processors.expand.max_docs: a number of documents is needed")
    return Config(paths, poll, floor if floor.tzinfo else floor.replace(tzinfo=UTC), skew, policy, most, _sink(given, environment))


def _sink(given: dict, environment: dict[str, str]) -> Writer | None:
    sink = _part(given, "sink", ("address", "token_env", "graph", "trusted_writers"))
    if not sink:
        return None
    name = sink.get("token_env", "")
    if not sink.get("address") or not name:
        raise ConfigError("sink: needs an address and the name of the token's variable")
    try:
        return Writer(sink["address"], lambda: environment[name], sink.get("graph", ""), tuple(sink.get("trusted_writers") or ()))
    except ValueError as error:
        raise ConfigError(f"sink: {error}") from error


def load(path: str) -> Config:
    """Read a .json file, or YAML where a reader for it is installed."""
    with open(path, encoding="utf-8") as file:
        if path.endswith(".json"):
            return parsed(json.load(file))
        import yaml

        return parsed(yaml.safe_load(file) or {})
