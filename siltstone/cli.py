"""python -m siltstone.cli COMMAND: crawl, runs, activate, reject, rollback, prune, search, search-run, help."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable

from siltstone import config as settings

#: Exit codes: all well, a command that failed, wrong use, and a failure that may pass (an index in use).
OK, FAILED, USAGE, BUSY = 0, 1, 2, 75


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="siltstone", add_help=True)
    main.add_argument("--store", required=True, help="folder shared by all executors")
    main.add_argument("--config")
    commands = main.add_subparsers(dest="command", required=True)
    commands.add_parser("migrate")
    crawl = commands.add_parser("crawl")
    crawl.add_argument("--index")
    runs = commands.add_parser("runs")
    runs.add_argument("--index")
    runs.add_argument("--limit", type=int, default=50)
    activate = commands.add_parser("activate")
    activate.add_argument("run_id")
    activate.add_argument("--allow-caution", action="store_true")
    for name in ("reject", "report"):
        commands.add_parser(name).add_argument("run_id")
    commands.add_parser("rollback").add_argument("index")
    prune = commands.add_parser("prune")
    prune.add_argument("--older-than")
    prune.add_argument("--status", action="append")
    prune.add_argument("--keep-last", type=int)
    for name in ("search", "search-run"):
        search = commands.add_parser(name)
        search.add_argument("--index", required=True)
        search.add_argument("--limit", type=int, default=10)
        if name == "search-run":
            search.add_argument("--run", required=True)
        search.add_argument("query", nargs="+")
    return main


def run(argv: list[str], spark, embedder: Callable[[dict], Callable] | None = None, transports: dict | None = None, out=print, verifier: Callable[[dict], Callable] | None = None) -> int:
    """Everything but the session and the network is here; both are given from outside."""
    from siltstone.operators import gate, search
    from siltstone.operators.embedding import HashEmbedder
    from siltstone.operators.refresh import Refresh
    from siltstone.operators.store import LifecycleError, Store, listed_runs
    from siltstone.operators.verification import Verification
    from siltstone.sources.registry import retry_options

    try:
        args = parser().parse_args(argv)
    except SystemExit as stop:
        return USAGE if stop.code else OK
    store = Store(spark, args.store)
    loaded, mark = settings.load(args.config) if args.config else ({"indexes": []}, None)
    checks = loaded.get("verification") or {}
    attestations = checks.get("attestations") or {}
    verification = Verification(verifier(checks) if verifier and checks.get("provider", "noop") != "noop" else None, checks, retries=retry_options(checks, ""), prose=bool(checks.get("prose_summary")))
    make = embedder or (lambda index: HashEmbedder(index["embedding"]["embedding_dimensions"]))
    refresh = Refresh(spark, store, transports or {}, {i["name"]: make(i) for i in loaded["indexes"] if (i.get("embedding") or {}).get("provider", "noop") != "noop"}, verification, attestor=attestations.get("attestor", "local"), trusted=attestations.get("trusted") or [], config_hash=mark)
    try:
        if args.command == "crawl":
            limits = gate.Thresholds(**(checks.get("deterministic_thresholds") or {}))
            results = refresh.run_all(settings.selected(loaded, args.index), limits, (loaded.get("retention") or {}).get("max_age_days"))
            for r in results:
                out(r.get("report") or f"{r['index_name']}: {r['error']}")
            failed = [r["error"] for r in results if "error" in r]
            return OK if not failed else BUSY if all("in use" in f for f in failed) else FAILED
        if args.command == "runs":
            for r in listed_runs(store.runs().withColumnRenamed("run_id", "id"), args.index, args.limit).toLocalIterator():
                out(f"{r['id']} {r['index_name']} {r['lifecycle_status']} {r['verification_verdict']} {r['started_at']}")
        elif args.command == "migrate":
            out(f"layout {store.migrate()}")
        elif args.command == "report":
            store.require(args.run_id)
            kept = store.read("reports", args.run_id).first()
            out(kept["report"] if kept else f"{args.run_id} has no report")
        elif args.command == "activate":
            store.activate(args.run_id, args.allow_caution)
        elif args.command == "reject":
            store.reject(args.run_id)
        elif args.command == "rollback":
            out(store.rollback(args.index))
        elif args.command == "prune":
            cutoff = store.clock() - settings.duration(args.older_than) if args.older_than else None
            for gone in store.prune(older_than=cutoff, statuses=args.status, keep_last=args.keep_last):
                out(gone)
        elif args.command in ("search", "search-run"):
            index = settings.selected(loaded, args.index)[0]
            words = " ".join(args.query)
            found = refresh.search(index, words, args.limit) if args.command == "search" else search.top_k(store.read("chunks", args.run), refresh.embedders[index["name"]]([words])[0], args.limit)
            for r in found.toLocalIterator():
                out(f"{r['score']:.4f} {r['canonical_url']} {r['content'][:80]!r}")
    except (LifecycleError, settings.ConfigError, ValueError) as problem:
        out(str(problem))
        return BUSY if "in use" in str(problem) else FAILED
    return OK


def main() -> None:
    from siltstone.session import get_session, release

    spark = get_session("siltstone")
    try:
        code = run(sys.argv[1:], spark)
    finally:
        release(spark)
    sys.exit(code)


if __name__ == "__main__":
    main()
