import json
import time
from datetime import UTC, datetime, timedelta

import pytest

from siltstone import config
from siltstone.operators import report
from siltstone.operators.store import LifecycleError, Store, auto_action, not_activatable
from siltstone.operators.verification import HttpVerifier, Packer, PromptTooLarge, Verification, build_prompts, combine, input_hash, parse_result, wants_prose, with_prose
from siltstone.sources.retry import RequestFailed, category, failure, seconds_after, with_retries


@pytest.fixture()
def store(spark, tmp_path):
    clock = {"now": datetime(2024, 1, 1)}
    made = Store(spark, str(tmp_path / "store"), lambda: clock["now"])
    made.turn = lambda days: clock.update(now=clock["now"] + timedelta(days=days))
    return made


def complete(store, index="i", verdict="pass", **metadata):
    run = store.create_run(index, metadata)
    store.record(run, index, "complete", "complete", verdict)
    store.turn(1)
    return run


def test_activation_rollback_and_guards(store):
    first, second, third = complete(store), complete(store, verdict="caution"), complete(store, verdict="fail")
    store.activate(first)
    with pytest.raises(LifecycleError, match="caution"):
        store.activate(second)
    store.activate(second, allow_caution=True)
    assert store.pointer("i") == {"name": "i", "live_run_id": second, "previous_live_run_id": first}
    assert store.run(first)["lifecycle_status"] == "superseded"
    with pytest.raises(LifecycleError):
        store.activate(third)
    with pytest.raises(LifecycleError):
        store.reject(second)
    with pytest.raises(LifecycleError, match="superseded"):
        store.activate(first)
    store.reject(third)
    assert store.run(third)["lifecycle_status"] == "rejected"
    assert store.rollback("i") == first
    assert store.pointer("i")["previous_live_run_id"] == second
    with pytest.raises(LifecycleError):
        store.rollback("other")


def test_runs_without_a_provider_stay_inactive(store):
    run = complete(store, embeddings_disabled=True)
    assert "provider" in not_activatable(store.run(run))
    assert auto_action(True, False, "openai", "pass") == "activate"
    assert {auto_action(*x) for x in ((False, False, "openai", "pass"), (True, True, "openai", "pass"), (True, False, "noop", "pass"), (True, False, "openai", "caution"))} == {"hold"}


def test_write_read_and_prune(spark, store):
    runs = [complete(store) for _ in range(5)]
    for run in runs:
        store.write("documents", run, spark.createDataFrame([("s", run)], "source_id string, canonical_url string"))
    store.write("documents", runs[0], spark.createDataFrame([("s", "again")], "source_id string, canonical_url string"))
    assert store.read("documents", runs[0]).first()["canonical_url"] == "again"
    store.activate(runs[1])
    store.activate(runs[2])
    store.turn(90)
    with pytest.raises(ValueError):
        store.prune()
    gone = store.prune(older_than=store.clock() - timedelta(days=30), keep_last=2)
    assert gone == [runs[0]]
    assert store.read("documents").filter(f"run_id = '{runs[0]}'").count() == 0
    assert sorted(r["run_id"] for r in store.runs().collect()) == sorted(runs[1:])


def test_lock_and_orphans(store):
    run = store.create_run("i")
    store.record(run, "i", "crawling", "crawling")
    young = store.create_run("j")
    with store.lock("i"):
        with pytest.raises(LifecycleError), store.lock("i"):
            pass
        assert store.reconcile() == []
    assert store.reconcile() == [run]
    store.turn(2)
    assert store.reconcile() == [young]
    with pytest.raises(ValueError):
        store.record(run, "i", "nonsense", "x")


def test_a_lease_lapses_with_its_holder(store):
    run = store.create_run("i")
    store.record(run, "i", "crawling", "crawling")
    gone = store.lock("i", 120)
    check = gone.__enter__()
    assert store.is_locked("i") and store.reconcile() == []
    store.turn(1)  # the holder was killed: nothing renewed the lease
    assert not store.is_locked("i") and store.reconcile() == [run]
    with pytest.raises(LifecycleError, match="lost"):
        check()
    with store.lock("i") as held:
        held()
        gone.__exit__(None, None, None)
        held()


def test_leases_are_renewed(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    with store.lock("i", 1.5) as check:
        first = store.lease("i")["until"]
        time.sleep(2.5)
        check()
        assert store.lease("i")["until"] > first
    assert store.lease("i") is None


def test_tables_of_a_run_show_together_and_pruning_frees(spark, store, tmp_path):
    frame = spark.createDataFrame([("s", "u")], "source_id string, canonical_url string")
    old, new = complete(store), complete(store)
    assert store.read("documents").count() == 0 and store.read("chunks", old).count() == 0
    for run in (old, new):
        store.persist(run, {"documents": frame, "sources": frame})
    with pytest.raises(Exception, match="no column|cannot be resolved|UNRESOLVED"):
        store.persist(new, {"documents": frame.limit(0), "chunks": frame.select("nothing")})
    assert store.read("documents", new).count() == 1
    files = lambda: [p for p in (tmp_path / "store").rglob("*.parquet") if p.is_file()]
    before = len(files())
    store.persist(new, {"documents": frame})
    assert len(files()) == before and store.read("documents").count() == 2
    store.drop_run(old)
    assert not [p for p in (tmp_path / "store").rglob("*") if old in str(p)] and store.run(old) is None
    assert store.read("documents").count() == 1


def test_results_outlive_only_runs_that_refer_to_them(store):
    runs = [complete(store) for _ in range(3)]
    for run, key in zip(runs, ("a", "b", "b")):
        store.save_verification(run, "pass", {"verdict": "caution", "llm": {"verdict": "caution"}, "source": "provider", "input_hash": key}, [{"check": "c", "verdict": "pass", "actual": 1.0, "threshold": 2.0}])
        store.attest(key, "local", {"verdict": "caution"})
        store.save_report(run, "short", "long")
    store.turn(1)
    store.attest("b", "other", {"verdict": "pass"})
    store.attest("b", "local", {"verdict": "fail"})
    assert store.attested("b", ["none", "other", "local"]) == ("other", {"verdict": "pass"}) and store.attested("b", ["local"])[1] == {"verdict": "fail"}
    kept = {(r["input_hash"], r["attestor"]): r for r in store.attestations().collect()}
    assert len(kept) == 3 and kept["b", "local"]["created_at"] < kept["b", "local"]["last_used_at"]
    row = store.read("verifications", runs[0]).first()
    assert (row["deterministic_verdict"], row["final_verdict"], row["findings"][0]["check"], row["input_hash"]) == ("pass", "caution", "c", "a")
    assert store.read("reports", runs[0]).first()["report"] == "long" and store.read("reports").count() == 3
    store.point("i", runs[2], None)
    store.turn(90)
    assert store.prune(statuses=["complete"]) == runs[:2]
    assert {(r["input_hash"], r["attestor"]) for r in store.attestations().collect()} == {("b", "local"), ("b", "other")}


def test_layouts(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.migrate() == 2
    store.folder.write("99", "version")
    with pytest.raises(LifecycleError, match="layout 99"):
        Store(spark, str(tmp_path / "s"))


GOOD = {"indexes": [{"name": "i", "embedding": {"provider": "hash", "embedding_dimensions": 8}, "sources": [{"id": "s", "type": "local", "root": "/x"}]}]}


def changed(**paths):
    made = json.loads(json.dumps(GOOD))
    for path, value in paths.items():
        at = made["indexes"][0] if path.startswith("i_") else made["indexes"][0]["sources"][0] if path.startswith("s_") else made
        at[path.split("_", 1)[1] if path[1] == "_" else path] = value
    return made


def test_config_passes():
    assert config.check(GOOD) is GOOD
    assert [i["name"] for i in config.selected(GOOD)] == ["i"]
    with pytest.raises(config.ConfigError):
        config.selected(GOOD, "x")


@pytest.mark.parametrize(
    "bad",
    [
        {"indexes": []}, changed(i_unknown=1), changed(i_chunking={"max_tokens": 0}), changed(i_chunking={"max_tokens": 100, "safety_multiplier": 2, "max_input_tokens": 150}), changed(i_embedding={"provider": "openai", "embedding_dimensions": 8}),
        changed(i_embedding={"embedding_dimensions": 0}), changed(s_type="ftp"), changed(s_root=None), changed(s_max_pages=0), changed(s_inter_request_delay_ms=-1), changed(i_languages={"allowed": ["en"], "fallback": "de"}),
        changed(s_language={"mode": "configured"}), changed(s_language={"mode": "guess"}), {**GOOD, "verification": {"temperature": 1, "top_p": 1}}, {**GOOD, "verification": {"temperature": 3}},
        {**GOOD, "verification": {"deterministic_thresholds": {"max_removed_percentage": 2}}}, {**GOOD, "verification": {"attestations": {"trusted": ["a", "a"]}}}, {**GOOD, "retention": {"max_age_days": 0}},
    ],
)
def test_config_refuses(bad):
    with pytest.raises(config.ConfigError):
        config.check(bad)


def test_interpolation_redaction_and_hash(tmp_path):
    assert config.interpolate({"a": ["${X}/b"]}, {"X": "1"}) == {"a": ["1/b"]}
    with pytest.raises(config.ConfigError):
        config.interpolate("${MISSING}", {})
    assert config.redact({"api_key": "s", "x": [{"password": "p", "n": 1}]}) == {"api_key": "***", "x": [{"password": "***", "n": 1}]}
    assert config.structural_hash({"a": 1, "api_key": "1"}) == config.structural_hash({"api_key": "2", "a": 1}) != config.structural_hash({"a": 2, "api_key": "1"})
    path = tmp_path / "c.json"
    path.write_text(json.dumps(GOOD))
    assert config.load(str(path), {})[0] == GOOD


def test_durations():
    assert config.duration("30d") == timedelta(days=30) == config.duration("P30D")
    assert config.duration("PT12H") == config.duration("12h")
    with pytest.raises(config.ConfigError):
        config.duration("soon")


def test_retries():
    waits, calls = [], []

    def call():
        calls.append(1)
        raise RequestFailed(503, retry_after="7")

    with pytest.raises(RequestFailed):
        with_retries(call, 3, first=1, jitter=0, longest=5, sleep=waits.append)
    assert (len(calls), waits) == (3, [5, 5])
    calls.clear()
    with pytest.raises(RequestFailed):
        with_retries(lambda: (calls.append(1), (_ for _ in ()).throw(RequestFailed(404)))[0], 3, sleep=waits.append)
    assert len(calls) == 1
    now = datetime(2024, 1, 1, tzinfo=UTC)
    assert (seconds_after("12"), seconds_after("Mon, 01 Jan 2024 00:00:30 GMT", now), seconds_after("nonsense"), seconds_after(None)) == (12.0, 30.0, 0.0, 0.0)
    assert (category(404), category(429), category(500), failure(RequestFailed(500, "x" * 2000))["message"][-3:]) == ("not-found", "busy", "fault", "...")


def entry(url, **extra):
    return {"source_id": "s", "canonical_url": url} | extra


BASE = {"index_name": "i", "gate": {"verdict": "pass"}, "diff": {"summary": {"added": 2}, "added": [entry("/a"), entry("/b")], "removed": [entry("/z")], "changed": [entry("/c", previous_hash="1", current_hash="2")]}}


def document(url, n=3, size=200, **extra):
    return entry(url, chunks=[{"content_hash": f"{url}{i}", "content": f"word{i} " * size} for i in range(n)], **extra)


def test_prompts_cover_everything_within_the_budget():
    docs = [document("/a"), document("/c", 6, content_changes={"added": ["x"]})]
    prompts = build_prompts(BASE, docs, 2500)
    assert len(prompts) > 2 and all(Packer(BASE, 2500).size([]) <= 2500 for _ in prompts)
    whole = "".join(prompts)
    assert all(f'"content_hash": "\\/{u}{i}"' in whole for u, n in (("a", 3), ("c", 6)) for i in range(n))
    assert whole.count('"content_changes": ') == 1 and "content_changes_continuation" in whole
    assert "\\/z" in prompts[-1] and "\\/b" in prompts[-1] and "(entries)" not in prompts[0]
    assert len(build_prompts({"index_name": "i", "diff": {}}, [])) == 1


def test_what_cannot_fit_fails_before_any_call():
    called = []
    with pytest.raises(PromptTooLarge):
        Verification(lambda p: called.append(p)).run(BASE, [document("/a", 1, 20_000)], "pass", 2500)
    assert not called


def test_results_and_hash():
    answer = lambda v, r="": json.dumps({"verdict": v, "reasoning": r, "findings": [v]})
    both = combine([parse_result(answer("pass", "fine")), parse_result(answer("caution", "odd")), parse_result(answer("caution", "odd"))])
    assert both["verdict"] == "caution" and both["findings"] == ["pass", "caution", "caution"] and "caution in batches 2, 3: odd" in both["reasoning"]
    assert combine([])["verdict"] == "pass"
    with pytest.raises(ValueError):
        parse_result('{"verdict": "maybe"}')
    many = combine([parse_result(answer("caution", str(i))) for i in range(3)])
    assert wants_prose(many) and with_prose(many, lambda c: "short")["reasoning"] == "short"
    assert with_prose(many, lambda c: 1 / 0)["reasoning"] == many["reasoning"]
    one = input_hash({"model": "m", "endpoint": "x"}, ["p"])
    assert one == input_hash({"model": "m", "endpoint": "y"}, ["p"]) != input_hash({"model": "n"}, ["p"])


def test_trusted_results_go_first():
    kept = {}
    make = lambda trusted=None: Verification(lambda p: '{"verdict": "pass"}', {"model": "m"}, lambda k: trusted, kept.get, kept.__setitem__)
    assert make().run(BASE, [], "pass")["source"] == "provider"
    assert make().run(BASE, [], "pass")["source"] == "cache"
    assert make({"verdict": "fail"}).run(BASE, [], "pass")["verdict"] == "fail"
    assert Verification(None).run(BASE, [], "pass")["verdict"] == "caution"


def test_providers_of_answers():
    seen = []
    chat = lambda p: (seen.append(p), {"choices": [{"message": {"content": "ok"}}]})[1]
    assert HttpVerifier("openai", chat, {"model": "m"})("hello") == HttpVerifier("azure-openai", chat, {"top_p": 0.5})("hello") == "ok"
    assert seen[0]["model"] == "m" and seen[0]["temperature"] == 0 and "model" not in seen[1] and seen[1]["top_p"] == 0.5 and "temperature" not in seen[1]
    vertex = lambda p: (seen.append(p), {"candidates": [{"content": {"parts": [{"text": "fine"}]}}]})[1]
    assert HttpVerifier("vertex-ai", vertex, {"max_output_tokens": 9})("hello") == "fine" and seen[2]["generationConfig"]["maxOutputTokens"] == 9
    with pytest.raises(ValueError):
        HttpVerifier("other", chat)


def test_calls_are_retried_summed_up_and_old_results_refreshed():
    calls, waits = [], []

    def answer(prompt):
        calls.append(prompt)
        if len(calls) == 1:
            raise RequestFailed(503)
        return "all in one line" if "short paragraph" in prompt else json.dumps({"verdict": "caution", "reasoning": f"r{len(calls)}"})

    docs = [document(f"/{i}", 3, 900) for i in range(3)]
    made = Verification(answer, retries={"attempts": 2, "sleep": waits.append}, prose=True)
    result = made.run({"index_name": "i", "diff": {}}, docs, "pass", 5000)
    assert len(waits) == 1 and result["llm"]["reasoning"] == "all in one line" and result["llm"]["verdict"] == "caution"
    old = {"verdict": "pass", "batches": [{"verdict": "pass", "reasoning": "x"}, {"verdict": "fail", "reasoning": "y"}]}
    again = Verification(answer, saved=lambda key: old).run({"index_name": "i", "diff": {}}, docs, "pass", 5000)
    assert again["verdict"] == "fail" and again["source"] == "cache" and again["llm"]["tallies"] == {"pass": 1, "caution": 0, "fail": 1}


def test_report_and_notice():
    run = {"index_name": "i", "verdict": "caution", "document_count": 3, "diff": {"added_count": 1}, "findings": [{"check": "c", "verdict": "caution", "actual": 2, "threshold": 1}], "timings": {"crawl": 12.3}}
    text = report.full_report(run, [{"source_id": "s", "document_count": 3, "error_count": 1}], [{"change_type": "added", "canonical_url": "/<a>" + "x" * 200}], 2)
    assert "[CHECK] i" in text and "1 failed" in text and "&lt;a&gt;" in text and "... and 2 more" in text and "crawl: 12 ms" in text
    assert report.notify(None, "u", {})["status"] == "skipped"
    assert report.notify(lambda u, b: 500, "u", {})["status"] == "failed"
    assert report.notify(lambda u, b: 1 / 0, "u", {})["status"] == "failed"
    assert report.notify(lambda u, b: 204, "u", {})["status"] == "sent"
