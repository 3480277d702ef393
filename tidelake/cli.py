"""Command line: python -m tidelake.cli COMMAND --base-dir DIR ... Exit codes: 0 fine, 1 findings, 2 bad arguments or divergence."""

from __future__ import annotations

import argparse
import importlib
import json
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from tidelake.api import CHECKS, Lake
from tidelake.functions.timeutil import next_daily_run
from tidelake.runtime import build_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidelake")
    p.add_argument("--base-dir", required=True)
    p.add_argument("--master", default=None)
    p.add_argument("--json", action="store_true")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, date: bool = False, period: bool = False, state: bool = False, provider: bool = False) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        for n in ("exchange", "symbol", "stream"):
            c.add_argument(f"--{n}")
        if period:
            c.add_argument("--period", choices=("day", "week", "hour", "range"), required=True)
            for n in ("value", "since", "until"):
                c.add_argument(f"--{n}")
        else:
            c.add_argument("--date", required=date)
        if state:
            for n in ("state-dir", "data-dir", "report"):
                c.add_argument(f"--{n}")
            c.add_argument("--strict", action="store_true")
        if provider:
            c.add_argument("--provider", required=True, help="module:function(exchange, symbol, stream, start_ms, end_ms) that gives payloads")
        return c

    v = add("verify", True)
    v.add_argument("--full", action="store_true")
    v.add_argument("--repair-checksums", action="store_true")
    add("manifest", True)
    add("gaps")
    add("gaps-backfill", provider=True)
    b = add("backfill-cycle", provider=True)
    b.add_argument("--days", type=int, default=2)
    b.add_argument("--every-hours", type=float, help="goes on, a run each so many hours; without it one run")
    add("consolidate-day", True).add_argument("--keep-sources", action="store_true")
    c = add("consolidate-cycle")
    c.add_argument("--keep-sources", action="store_true")
    c.add_argument("--daily-at", help="HH:MM UTC: goes on, a run each day; without it one run")
    for s in CHECKS:
        add(f"check-{s}", True)
    add("audit-files", period=True)
    add("audit-state", period=True, state=True)
    add("audit-reconcile", period=True, state=True)
    add("audit-backfill", period=True, state=True, provider=True)
    m = sub.add_parser("mark-maintenance")
    for n in ("id", "scope", "planned-by", "reason", "state-dir"):
        m.add_argument(f"--{n}", required=True)
    m.add_argument("--ttl-minutes", type=int, default=60)
    add("torn").add_argument("--repair", action="store_true")
    return p


def _show(df: DataFrame, as_json: bool) -> int:
    """Prints every row, one partition after the other; how many there are."""
    n = 0
    for r in df.toLocalIterator():
        print(json.dumps(r.asDict(True), default=str) if as_json else "  ".join("" if x is None else str(x) for x in r))
        n += 1
    return n


def _provider(name: str) -> Callable:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _divergence(out: dict[str, DataFrame], as_json: bool) -> int:
    """Prints what is unexplained or orphaned and the summary: 2 if anything is unexplained, else 0."""
    bad = _show(out["unexplained"], as_json)
    _show(out["orphan_state"], as_json)
    _show(out["summary"], as_json)
    return 2 if bad else 0


def _again(wait_s: Callable[[], float] | None, run: Callable[[], int]) -> int:
    """Runs once, or for ever with waits between (the last exit code if it is interrupted)."""
    code = run()
    while wait_s is not None:
        try:
            time.sleep(wait_s())
        except KeyboardInterrupt:
            break
        code = run()
    return code


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    as_json = a.json
    lake = Lake(build_session("tidelake", a.master), a.base_dir)
    if a.command == "mark-maintenance":
        _show(lake.mark_maintenance(a.id, a.scope, a.planned_by, a.reason, a.ttl_minutes, a.state_dir), as_json)
        return 0
    names = {k: getattr(a, k) for k in ("exchange", "symbol", "stream")}
    if a.command == "verify":
        errors, found = lake.verify(a.date, **names, full=a.full, repair_checksums=a.repair_checksums)
        n = _show(errors.orderBy("check_no", "file_path", "line_no"), as_json)
        print(f"errors: {n}, gaps: {_show(found, as_json)}")
        return int(n > 0)
    if a.command == "manifest":
        _show(lake.manifest(a.date), as_json)
        return 0
    if a.command == "gaps":
        _show(lake.missing_hours(a.date, **names), as_json)
        return 0
    if a.command == "gaps-backfill":
        done = lake.backfill_hours(_provider(a.provider), a.date, **names)
        _show(done, as_json)
        return int(done.where("status = 'failed'").limit(1).count() > 0)
    if a.command == "backfill-cycle":

        def fetch() -> int:
            lake.now_ms = int(time.time() * 1000)
            done = lake.backfill_cycle(_provider(a.provider), a.days, **names)
            print(json.dumps(done))
            return int(done["failed"] > 0)

        return _again((lambda: a.every_hours * 3600) if a.every_hours else None, fetch)
    if a.command == "consolidate-day":
        done = lake.consolidate(a.date, **names, keep_sources=a.keep_sources)
        for r in done:
            print(json.dumps(r, default=str))
        return int(not all(r["success"] for r in done))
    if a.command == "consolidate-cycle":

        def seal() -> int:
            lake.now_ms = int(time.time() * 1000)
            done = lake.consolidation_cycle(a.keep_sources)
            print(json.dumps(done))
            return int(done["any_failed"])

        at = [int(x) for x in a.daily_at.split(":")] if a.daily_at else None
        return _again((lambda: next_daily_run(time.time_ns(), *at) / 1e9 - time.time()) if at else None, seal)
    if a.command.startswith("check-"):
        return int(_show(lake.check(a.command.removeprefix("check-"), a.date, a.exchange, a.symbol), as_json) > 0)
    if a.command.startswith("audit-"):
        try:
            start, end = lake.scope(a.period, a.value, a.since, a.until)
        except ValueError as e:
            print(e, file=sys.stderr)
            return 2
        scope = {k: [v] if v else None for k, v in names.items()}
        if a.command == "audit-files":
            _show(lake.audit_files(start, end, **scope), as_json)
            return 0
        if a.command == "audit-state":
            _show(lake.audit_state(start, end, strict=a.strict, **lake.state_inputs(a.state_dir, a.data_dir), **scope), as_json)
            return 0
        options = {"state_dir": a.state_dir, "data_dir": a.data_dir, "strict": a.strict, "report": a.report, **scope}
        if a.command == "audit-reconcile":
            return _divergence(lake.audit(start, end, **options), as_json)
        done, out = lake.audit_backfill(_provider(a.provider), start, end, **options)
        print(json.dumps(done))
        return _divergence(out, as_json)
    if a.repair:
        print(f"repaired: {lake.repair_tails()}")
        return 0
    return int(_show(lake.torn_tails(), as_json) > 0)


if __name__ == "__main__":
    sys.exit(main())
