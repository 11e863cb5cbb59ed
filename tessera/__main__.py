"""Entry points: python -m tessera bulk | one NAME | registry | usage. Settings come from the environment."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Mapping

from tessera.config import Config


def main(arguments: list[str] | None = None, settings: Mapping[str, str] | None = None, session=None) -> int:
    parser = argparse.ArgumentParser("tessera", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("bulk", help="work on the whole list")
    one = commands.add_parser("one", help="resolve one entity, without storing it")
    one.add_argument("name")
    one.add_argument("--type", default="unknown", choices=("person", "organization", "unknown"))
    commands.add_parser("registry", help="download the registry anew")
    commands.add_parser("usage", help="what is spent of today's search budget")
    asked = parser.parse_args(arguments)
    config = Config.from_mapping(settings)
    logging.basicConfig(level=config.log_level.upper(), format="%(asctime)s %(levelname)s %(message)s")

    from tessera.sources.store import Ledger

    ledger = Ledger(config.ledger_path, config.llm_timezone)
    if asked.command == "usage":
        print(ledger.report(config.llm_model, config.llm_daily_budget))
        return 0

    from pyspark.sql import SparkSession

    from tessera.plans.bulk import Engine
    from tessera.sources.registry_api import download
    from tessera.sources.search_api import HttpProvider

    spark = session or SparkSession.builder.appName("tessera").config("spark.sql.session.timeZone", "UTC").config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    rows = (lambda: download(spark, config, url=config.registry_url)) if config.registry_url else None
    engine = Engine(spark, config, rows, HttpProvider(config) if config.llm_url else None, ledger)
    if asked.command == "bulk":
        stats, _ = engine.run()
        print(json.dumps(stats._asdict()))
    elif asked.command == "one":
        print(json.dumps(engine.resolve_one(asked.name, asked.type), ensure_ascii=False, indent=2))
    else:
        print(engine.ensure_registry(force=True).count())
    return 0


if __name__ == "__main__":
    sys.exit(main())
