"""python -m provgraph CONFIG [--store FOLDER] [--checkpoint FOLDER] [--metrics PORT]: a pass over the configured receivers, or, where they poll, batches until interrupted; prints the receipt."""

from __future__ import annotations

import argparse
import signal

from provgraph import config
from provgraph.metrics import Metrics
from provgraph.operators.store import Store
from provgraph.run import Run, Stopped
from provgraph.session import session
from provgraph.sources import lookup
from provgraph.streaming.ingest import drain


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser("provgraph")
    parser.add_argument("config")
    parser.add_argument("--store", default="")
    parser.add_argument("--checkpoint", default="", help="where a polling run keeps its place; needed for polling")
    parser.add_argument("--metrics", type=int, default=-1, help="port of /metrics and /healthz")
    for name in ("european", "registry", "advisories"):
        parser.add_argument(f"--{name}-url", default="")
    given = parser.parse_args(arguments)
    try:
        settings = config.load(given.config)
    except (config.ConfigError, OSError, ValueError) as error:
        parser.error(str(error))
    if settings.sink is None and not given.store:
        parser.error("a sink or a store is needed")
    if settings.poll and not given.checkpoint:
        parser.error("polling needs a checkpoint folder")
    spark, metrics, answers = session(), Metrics(), []
    server = metrics.serve(given.metrics) if given.metrics >= 0 else None
    run = Run(spark, settings, Store(spark, given.store) if given.store else None, lookup.live(answers, given.european_url, given.registry_url, given.advisories_url), metrics=metrics)
    failed = False
    try:
        if settings.poll:
            query = run.poll(given.checkpoint)
            signal.signal(signal.SIGTERM, lambda *_: drain(query))
            try:
                query.awaitTermination()
            except KeyboardInterrupt:
                drain(query)
        else:
            run.once()
    except Stopped as stopped:
        failed = True
        print(f"stopped: {stopped}")
    finally:
        print(run.receipt)
        run.close()
        lookup.shared.removed(spark, *answers)
        if server is not None:
            server.shutdown()
    return int(failed)


if __name__ == "__main__":
    raise SystemExit(main())
