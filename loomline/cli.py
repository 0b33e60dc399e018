"""Command line: python -m loomline.cli COMMAND ..."""

from __future__ import annotations

import argparse
import json

from . import config


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="loomline")
    p.add_argument("--config")
    commands = p.add_subparsers(dest="command", required=True)
    for name, fields in {"process": ("input", "output"), "inspect": ("caches",), "evaluate": ("queries", "run"), "doctor": (), "backfill": ("caches", "output"), "export-dense": ("caches", "output"), "check-delta": ("delta",)}.items():
        c = commands.add_parser(name)
        for f in fields:
            c.add_argument(f)
    given = p.parse_args(args)
    settings = config.load(given.config)
    if given.command == "doctor":
        found = config.doctor(settings)
        print("\n".join(found) or "no warnings")
        return int(bool(found))
    if given.command == "check-delta":
        from .operators.delta import check_record

        with open(given.delta, encoding="utf-8") as f:
            check_record(json.load(f))
        return 0
    from pyspark.sql import SparkSession

    from .operators import representations, validation
    from .plans import jobs
    from .sources import caches

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if given.command == "process":
        jobs.process_transcripts(spark, given.input, given.output, settings).groupBy("node_type").count().show()
    elif given.command == "evaluate":
        print(jobs.markdown(jobs.evaluate(spark, given.queries, given.run, given.run.endswith(".jsonl"))[1]))
    else:
        envelopes = caches.read(spark, given.caches)
        if given.command == "inspect":
            nodes = caches.nodes(envelopes)
            status = validation.cache_status(nodes, validation.violations(nodes))
            status.show(truncate=False)
            return int(status.where("not valid").limit(1).count() > 0)
        if given.command == "backfill":
            caches.write_json(caches.backfill(envelopes), given.output)
        else:
            representations.dense_export(caches.envelope_rows(envelopes), caches.nodes(envelopes)).write.mode("overwrite").json(given.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
