"""Counters of a run, and their text for a scraper."""

from __future__ import annotations

import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

#: Counters with their labels.
COUNTERS = {
    "documents": ("outcome",),
    "records_emitted": ("kind",),
    "valid_time_fallbacks": (),
    "sink_retries": (),
    "expansion_documents": (),
    "documents_decorated": (),
    "documents_decorate_failed": (),
    "claims": (),
    "enrich_failures": ("source",),
}


class Metrics:
    """Counters of one process; the driver adds what jobs report."""

    def __init__(self):
        self._lock = threading.Lock()
        self._values: dict[tuple[str, tuple[str, ...]], int] = {(n, ()): 0 for n, labels in COUNTERS.items() if not labels}

    def add(self, counter: str, amount: int = 1, **labels: str) -> None:
        if amount < 0 or tuple(labels) != COUNTERS[counter]:
            raise ValueError(f"{counter} takes labels {COUNTERS[counter]} and never falls")
        with self._lock:
            key = (counter, tuple(labels.values()))
            self._values[key] = self._values.get(key, 0) + amount

    def text(self) -> str:
        """All counters, in order, one a line."""
        quoted = lambda v: v.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")
        lines = []
        with self._lock:
            for name, labels in COUNTERS.items():
                lines.append(f"# TYPE provgraph_{name}_total counter")
                for (counter, values), amount in sorted(self._values.items()):
                    if counter == name:
                        pairs = ",".join(f'{n}="{quoted(v)}"' for n, v in zip(labels, values, strict=True))
                        lines.append(f"provgraph_{name}_total{'{' + pairs + '}' if pairs else ''} {amount}")
        return "\n".join(lines) + "\n"

    def serve(self, port: int = 0, host: str = "127.0.0.1") -> ThreadingHTTPServer:
        """Answer /metrics and /healthz in a thread, until the server is shut down."""
        metrics = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self) -> None:  # noqa: N802
                body = {"/metrics": metrics.text(), "/healthz": "ok\n"}.get(self.path)
                self.send_response(404 if body is None else 200)
                self.send_header("Content-Type", "text/plain; version=0.0.4")
                self.end_headers()
                self.wfile.write((body or "").encode())

            def log_message(self, *args: object) -> None:
                """Requests aren't logged."""

        server = ThreadingHTTPServer((host, port), Handler)
        threading.Thread(target=server.serve_forever, daemon=True).start()
        return server
