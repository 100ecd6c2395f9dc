"""Commands: python -m tidewright COMMAND ..."""

from __future__ import annotations

import argparse
import json

from . import config
from .session import session


def main() -> None:
    parser = argparse.ArgumentParser(prog="tidewright")
    sub = parser.add_subparsers(dest="command", required=True)
    c = sub.add_parser("validate-config", help="check a file of settings")
    c.add_argument("path")
    c = sub.add_parser("show-topics", help="list subscription keys")
    c.add_argument("symbols", nargs="+")
    c = sub.add_parser("audit", help="audit raw segments")
    c.add_argument("raw")
    c.add_argument("--date")
    c = sub.add_parser("build", help="publish canonical tables of raw segments")
    c.add_argument("raw")
    c.add_argument("out")
    c.add_argument("--date")
    c = sub.add_parser("import-history", help="publish bars of a day's trades")
    for name in ("path", "out", "symbol", "date"):
        c.add_argument(name)
    c = sub.add_parser("collect", help="land files of envelopes, one a line, as raw segments")
    for name in ("lines", "out", "checkpoint"):
        c.add_argument(name)
    c.add_argument("--every", help="keep running, a batch in this interval")
    c.add_argument("--health", help="a JSON document of the stream's state")
    c = sub.add_parser("validate", help="compare a published dataset with its manifest")
    c.add_argument("path")
    a = parser.parse_args()
    if a.command == "validate-config":
        print(config.load(a.path))
    elif a.command == "show-topics":
        from .sources.feed import topics

        print("\n".join(topics(a.symbols)))
    else:
        from .plans import pipelines
        from .sources import tables

        spark = session()
        if a.command == "audit":
            for name, df in pipelines.audit(spark, a.raw, a.date).items():
                print(name)
                df.show(100, truncate=False)
        elif a.command == "build":
            print(json.dumps(pipelines.build_canonical(spark, a.raw, a.out, a.date)))
        elif a.command == "import-history":
            print(pipelines.import_history_day(spark, a.path, a.out, a.symbol, a.date))
        elif a.command == "collect":
            from .streaming import sinks

            if a.health:
                spark.streams.addListener(sinks.Health(spark, a.health))
            sinks.land(spark.readStream.text(a.lines), a.out, a.checkpoint, a.every).awaitTermination()
        else:
            print(json.dumps(tables.validate(spark, a.path)))


if __name__ == "__main__":
    main()
