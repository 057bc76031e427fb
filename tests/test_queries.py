"""Every query with SQL against DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

from tessera.plans import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, tmp_path, name):
    out = str(tmp_path / "out")
    queries.QUERIES[name](spark, SF).write.parquet(out)
    if name not in queries.ORACLES:
        assert spark.read.parquet(out).count() > 0
        return
    duck.execute(f"create or replace table want as {queries.ORACLES[name]}")
    duck.execute(f"create or replace view got as select * from '{out}/*.parquet'")
    kinds = [dict(r[:2] for r in duck.sql(f"describe {t}").fetchall()) for t in ("got", "want")]
    assert kinds[0] == kinds[1]
    cols = ", ".join(f'"{c}"' for c in sorted(kinds[0]))
    for a, b in (("got", "want"), ("want", "got")):
        assert duck.sql(f"select {cols} from {a} except all select {cols} from {b} limit 3").fetchall() == []


def test_perplexity_next_to_a_half(spark, tmp_path):
    """The JVM's and the C library's exp differ in the last bit, and the first value's sixth decimal with it."""
    rows = list(enumerate([91.23645416485998, None, float("nan"), float("inf"), float("-inf"), -0.0, -290.17, 99.99999999999999, 100.0, 2000.0]))
    spark.createDataFrame(rows, "event_id long, value double").write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    got = sorted(tuple(r) for r in queries.perplexity(spark, str(tmp_path)).collect())
    assert got == sorted(con.sql(queries.ORACLES["perplexity"]).fetchall()) and got[0][1] == 95.757859


def test_perplexity_up_to_a_loss_of_100(spark, tmp_path):
    """exp of every loss below 100, not below 5, to the last bit; infinite, not 1e308, from there on; null for a null."""
    rows = list(enumerate([100.0, 122.79, 560.21, 1999.9999999999998, 2000.0, float("inf"), float("nan"), None, *(k * 0.837 for k in range(2500))]))
    spark.createDataFrame(rows, "event_id long, value double").write.parquet(str(tmp_path / "events.parquet"))
    got = {r["event_id"]: (r["perplexity"], r["infinite"]) for r in queries.perplexity(spark, str(tmp_path)).collect()}
    for i, v in rows:
        p, infinite = got[i]
        if v is None:
            assert p is None and infinite is None
        elif v < 2000:
            e = math.exp(v / 20)
            assert abs(p - e) <= 5.1e-7 + e * 2.3e-16 and not infinite
        else:
            assert p == math.inf and infinite
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    assert {r[0]: r[1:] for r in con.sql(queries.ORACLES["perplexity"]).fetchall()} == got


def test_agent_traces_equal_a_plain_walk(spark):
    """Calls of user turns, results of the others, oldest call first, written out for the made incidents."""
    import hashlib
    import json

    turns = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))

    def walk(conv, said):
        out, asked, fresh, n, seen = [{"role": "user", "content": "find it"}], [], [], 0, []
        for role, text in said:
            if role == "user":
                fresh.append({"call_id": f"call_{n}", "name": "look", "arguments": {"q": text}})
                seen.append(text)
                n += 1
                continue
            if fresh:
                out.append({"role": "assistant", "content": "", "tool_calls": fresh})
                asked, fresh = asked + fresh, []
            if not asked:
                return "tool_result_without_call", None
            call, asked = asked[0], asked[1:]
            if not text.strip():
                return "empty_tool_output", None
            out.append({"role": "tool", "call_id": call["call_id"], "name": "look", "content": text})
        if asked or fresh:
            return "assistant_before_tool_group_complete", None
        out.append({"role": "assistant", "content": "done"})
        tool = {"name": "look", "description": "looks", "parameters": {"type": "object", "properties": {"q": {"type": "string"}}, "required": ["q"], "additionalProperties": False}}
        meta = {"failure_type": f"kind{conv % 5}", "issue_category": "made", "incident_id": str(conv), "success": True, "original_source": queries.agent.AGENT["origin"], "is_anomaly": True, "faulty_devices": ["r1"], "root_cause_name": [], "scenario": "", "backend_model": "", "scenario_topo_size": ""}
        row = {"id": f"nika_{conv}", "source": "nika", "task_type": "network_agent", "system": "You find faults.", "tools": [tool] if seen else [], "turns": out, "metadata": meta}
        return None, hashlib.sha256(json.dumps(row, ensure_ascii=False, sort_keys=True).encode()).hexdigest()

    got = {int(r["dir"].split("/")[-1]): (r["reason"], r["row_sha256"]) for r in queries.agent_traces(spark, SF).collect()}
    wanted = {c: walk(c, said) for c, said in turns.items()}
    assert got == wanted and len({r for r, _ in wanted.values()}) > 1


def test_plans_reach_the_scan(spark):
    plan = queries.token_estimate(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan and "Python" not in plan
    plan = queries.split_assign(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan
    plan = queries.exclusion_antijoin(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(toxic), EqualTo(toxic,1)" in plan


def test_stream_equals_batch(spark, tmp_path):
    from tessera.operators.cleaning import quality_checked
    from tessera.streaming import cleaning

    records = queries.documents(spark, SF)
    records.write.parquet(str(tmp_path / "in"))
    stream = cleaning.read_stream(spark, str(tmp_path / "in"), records.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), 1)
    cleaning.start(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = {r["verdict"]: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("verdict").count().collect()}
    want = {r["reason"] or "accepted": r["count"] for r in quality_checked(records).groupBy("reason").count().collect()}
    assert got == want
