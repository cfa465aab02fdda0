"""Command line: ``python -m kpiloom.cli serve|run|matrix|list-scenarios|add-vendor|version``."""

from __future__ import annotations

import argparse
import json
import signal
import sys
import threading
from pathlib import Path

import yaml

from kpiloom.registry import SHIPPED as REGISTRY
from kpiloom.registry import Registry
from kpiloom.operators.simulate import SHIPPED as SCENARIOS
from kpiloom.operators.simulate import Scenario, certify, matrix

VERSION = "0.1.0"


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("kpiloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def serve(args: argparse.Namespace) -> int:
    """Runs the pipeline of a configuration file until a signal, or for ``--seconds``."""
    from kpiloom.config import Config
    from kpiloom.operators.rules import SHIPPED as RULES
    from kpiloom.operators.rules import Rules
    from kpiloom.streaming.service import Service

    config, rules = Config.load(args.config), Rules.load(RULES, *args.rules)
    stopped = threading.Event()
    for s in (signal.SIGINT, signal.SIGTERM):
        signal.signal(s, lambda *_: stopped.set())
    if args.seconds is not None:
        timer = threading.Timer(args.seconds, stopped.set)
        timer.daemon = True
        timer.start()
    Service(_session(), config, args.path, rules, args.delay, args.grace, args.pace).run(stopped, args.patience)
    return 0


def run(args: argparse.Namespace) -> int:
    """Certifies one scenario file; exit code 1 if an expectation fails, whatever the output format."""
    rows = [r.asDict() for r in certify(_session(), [Scenario.load(args.scenario)], Registry.load(args.registry)).collect()]
    if args.output == "json":
        print(json.dumps(rows, indent=2))
    else:
        for r in sorted(rows, key=lambda r: r["rule"]):
            print(f"{'PASS' if r['passed'] else 'FAIL'} {r['scenario']} {r['rule']} at {r['at_sec']}")
    return int(not all(r["passed"] for r in rows))


def run_matrix(args: argparse.Namespace) -> int:
    """Certifies a directory of scenarios, grouped by rule and scenario, with a line for each vendor."""
    results = certify(_session(), Scenario.load_all(args.directory), Registry.load(args.registry))
    ok, vendors = True, set()
    for g in matrix(results).orderBy("rule", "base").collect():
        print(f"{'PASS' if g.ok else 'FAIL'} {g.rule} / {g.base}: {g.passed} of {g.total}")
        for v in g.vendors:
            vendors.add(v.vendor)
            print(f"  {'PASS' if v.passed else 'FAIL'} {v.vendor}" + ("" if v.at_sec is None else f" at {v.at_sec} s"))
        ok &= g.ok
    print(f"{len(vendors)} vendors")
    return int(not ok)


def list_scenarios(args: argparse.Namespace) -> int:
    for s in Scenario.load_all(args.directory):
        print(f"{s.name}\t{s.duration} s\t{len(s.expected)} expected")
    return 0


def scaffold(registry: Path, scenarios: Path, namespace: str, vendor: str) -> list[Path]:
    """Appends a vendor with placeholders to a namespace's file and writes a skeleton scenario; nothing is overwritten."""
    written = []
    file = registry / f"{namespace}.yaml"
    content = yaml.safe_load(file.read_text())
    vendors = content.setdefault("mappings" if "mappings" in content else "vendors", {})
    if vendor not in vendors:
        base = [k for k in content["kpis"] if "formula" not in k]
        kind = lambda k: "counter" if "count" in k["unit"] else "gauge"
        vendors[vendor] = {
            "protocol": "prometheus",
            "metrics": {k["name"]: {"metric": f"TODO_{vendor}_{k['name'].replace('.', '_')}", "type": kind(k), "reset_aware": kind(k) == "counter"} for k in base},
        }
        file.write_text(yaml.safe_dump(content, sort_keys=False, allow_unicode=True))
        written.append(file)
    skeleton = scenarios / f"{vendor}_{namespace}_steady_state.yaml"
    if not skeleton.exists():
        nf = {"type": namespace.upper(), "vendor": vendor, "instance_id": f"{namespace}-001", "protocol": "prometheus", "metrics": []}
        skeleton.write_text(yaml.safe_dump({"name": skeleton.stem, "duration": 120, "nfs": [nf], "expected_events": []}, sort_keys=False))
        written.append(skeleton)
    return written


def add_vendor(args: argparse.Namespace) -> int:
    for path in scaffold(Path(args.registry), Path(args.directory), args.namespace, args.vendor):
        print(f"wrote {path}")
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="kpiloom")
    parser.add_argument("--registry", default=str(REGISTRY))
    commands = parser.add_subparsers(dest="command", required=True)
    service = commands.add_parser("serve")
    service.add_argument("config")
    service.add_argument("--path", required=True, help="folder for records, events, state and progress; all executors share it")
    service.add_argument("--rules", nargs="*", default=[], help="rule files beside the shipped one")
    service.add_argument("--seconds", type=float)
    service.add_argument("--patience", type=float, default=30.0, help="seconds that running batches get when the service stops")
    service.add_argument("--delay", default="10 seconds")
    service.add_argument("--grace", default="1 minute")
    service.add_argument("--pace", default="5 seconds")
    service.set_defaults(call=serve)
    one = commands.add_parser("run")
    one.add_argument("scenario")
    one.add_argument("--output", choices=("text", "json"), default="text")
    one.set_defaults(call=run)
    for name, call in (("matrix", run_matrix), ("list-scenarios", list_scenarios)):
        c = commands.add_parser(name)
        c.add_argument("directory", nargs="?", default=str(SCENARIOS))
        c.set_defaults(call=call)
    add = commands.add_parser("add-vendor")
    add.add_argument("namespace")
    add.add_argument("vendor")
    add.add_argument("--directory", default=str(SCENARIOS))
    add.set_defaults(call=add_vendor)
    commands.add_parser("version").set_defaults(call=lambda _: print(VERSION) or 0)
    args = parser.parse_args(argv)
    return args.call(args)


if __name__ == "__main__":
    sys.exit(main())
