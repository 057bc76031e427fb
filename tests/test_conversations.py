import copy
import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import agent, chat
from tessera.operators.canonical import RENDERERS, check_row, dumps, render, validate, validation_summary
from tessera.plans import conversations as plan

TOOL = {"name": "probe", "description": "probes", "parameters": {"type": "object", "properties": {"target": {"type": "string"}}, "required": ["target"]}}
ROW = {
    "id": "x", "source": "s", "task_type": "t", "system": "", "tools": [TOOL], "metadata": {},
    "turns": [
        {"role": "user", "content": "Which of edge7 and core3 answers, and how fast?"},
        {"role": "assistant", "content": "", "tool_calls": [{"call_id": f"q{i}", "name": "probe", "arguments": {"target": t}} for i, t in enumerate(("edge7", "core3"))]},
        {"role": "tool", "call_id": "q0", "name": "probe", "content": "3 ms"},
        {"role": "tool", "call_id": "q1", "name": "probe", "content": "no reply"},
        {"role": "assistant", "content": "edge7 does, in 3 ms; core3 is silent."},
    ],
}


def broken(f):
    row = copy.deepcopy(ROW)
    f(row)
    return check_row(row)


def put(path, value):
    def change(row):
        at = row
        for p in path[:-1]:
            at = at[p]
        at[path[-1]] = value

    return change


@pytest.mark.parametrize(
    "change,part",
    [
        (lambda r: r.pop("tools"), "missing columns: ['tools']"),
        (put(["id"], ""), "id/source/task_type"),
        (put(["system"], 3), "system must be a string"),
        (put(["system"], "<|eot_id|>"), "system contains"),
        (put(["metadata"], []), "metadata must be"),
        (put(["tools"], {}), "tools must be a list"),
        (put(["tools"], [3]), "tools[0] is not an object"),
        (put(["tools"], [TOOL, TOOL]), "tools[1] has missing/duplicate name"),
        (put(["tools", 0, "description"], 1), "tools[0].description"),
        (put(["tools", 0, "parameters"], None), "tools[0].parameters"),
        (put(["turns"], []), "turns must be a non-empty list"),
        (lambda r: r["turns"].pop(0), "first turn must be user"),
        (put(["turns", 0], "text"), "turns[0] is not an object"),
        (put(["turns", 0, "role"], "system"), "turns[0] has invalid role 'system'"),
        (put(["turns", 0, "content"], "<tool_call>"), "turns[0] contains a model-specific token"),
        (put(["turns", 0, "content"], " "), "turns[0] has empty user content"),
        (lambda r: r["turns"].insert(2, {"role": "user", "content": "hm"}), "turns[2] user appears before tool results"),
        (lambda r: r["turns"].insert(2, {"role": "assistant", "content": "hm"}), "turns[2] assistant appears before tool results"),
        (put(["turns", 4, "content"], ""), "turns[4] assistant is empty"),
        (put(["turns", 1, "tool_calls", 0], 1), "turns[1].tool_calls[0] is not an object"),
        (put(["turns", 1, "tool_calls", 1, "call_id"], "q0"), "turns[1] has missing/duplicate call_id"),
        (put(["turns", 1, "tool_calls", 1, "name"], "dig"), "turns[1] references unknown tool 'dig'"),
        (put(["turns", 1, "tool_calls", 1, "arguments"], "{}"), "turns[1] tool arguments must be an object"),
        (put(["turns", 0, "tool_calls"], [1]), "turns[0] only assistant may contain tool_calls"),
        (put(["turns", 2, "call_id"], "other"), "turns[2] has unmatched call_id 'other'"),
        (put(["turns", 2, "name"], "other"), "turns[2] tool name does not match"),
        (put(["turns", 2, "content"], None), "turns[2] has empty tool output"),
        (lambda r: r["turns"].insert(3, {"role": "assistant", "content": "hm"}), "turns[3] interrupts a tool-result group"),
        (lambda r: r["turns"].insert(4, {"role": "user", "content": "hm"}), "turns[4] must be assistant after tool results"),
        (lambda r: r["turns"].pop(3), "missing tool results for ['q1']"),
        (lambda r: r["turns"].pop(4), "at least one non-empty assistant"),
        (lambda r: r["turns"].pop(4), "conversation must end with assistant"),
    ],
)
def test_rules(change, part):
    assert any(part in e for e in broken(change))


def test_valid_row_and_columns(spark):
    assert check_row(ROW) == []
    df = spark.createDataFrame([(dumps(ROW), "f1", 1), (dumps(ROW), "f2", 2), ("{", "f2", 3), ("[]", "f2", 4)], "row string, source string, ord long")
    got = {r["ord"]: r for r in validate(df, "row", "source").collect()}
    assert got[1]["errors"] == [] and got[1]["duplicate_of"] is None and got[2]["duplicate_of"] == "f1"
    assert got[3]["errors"] == ["row is not valid JSON"] and got[4]["errors"] == ["row is not an object"]
    table = {r["source"]: (r["rows"], r["bad_rows"], r["errors"]) for r in validation_summary(validate(df, "row", "source")).collect()}
    assert table == {"f1": (1, 0, 0), "f2": (3, 3, 3)}
    with pytest.raises(RuntimeError):
        plan.checked_rows(df, strict=True)


def test_rendering_adds_the_only_wrappers():
    before = copy.deepcopy(ROW)
    messages, tools = render(ROW)
    assert ROW == before and tools[0]["type"] == "function" and tools[0]["function"]["name"] == "probe"
    assert messages[1]["tool_calls"][0]["function"] == {"name": "probe", "arguments": {"target": "edge7"}} and messages[2]["tool_call_id"] == "q0"
    assert RENDERERS["llama"](ROW | {"system": "S"})[0][0] == {"role": "system", "content": "S"}


MESSAGES = [("user", " hi "), ("assistant", "hello")]


def test_chat_reasons_in_order(spark):
    rows = [("a", MESSAGES, 1), ("b", [("system", "s"), *MESSAGES], 2), ("c", [("assistant", "x")], 3), ("d", [("user", "x"), ("assistant", "y" * 40_000)], 4), ("res", MESSAGES, 0), ("e", [("user", " "), ("assistant", "y")], 5), ("f", [], 6), ("g", None, 7), ("", [("user", "q"), ("assistant", 'é "\\\n\t')], 8), (None, [("user", None), ("assistant", "y")], 9)]
    df = spark.createDataFrame(rows, f"prompt_id string, messages {chat.MESSAGES}, ord long")
    excluded = spark.createDataFrame([(" res ",), ("",)], "id string")
    checked = chat.check_chats(df, excluded).cache()
    bad = "empty_or_bad_role_sequence"
    assert {r["ord"]: r["reason"] for r in checked.collect()} == {0: "reserved_for_cpt", 1: None, 2: "exact_duplicate", 3: bad, 4: "overly_long", 5: bad, 6: bad, 7: bad, 8: None, 9: bad}
    import hashlib

    wanted = hashlib.sha256(json.dumps([{"role": "user", "content": "q"}, {"role": "assistant", "content": 'é "\\'}], ensure_ascii=False, sort_keys=True).encode()).hexdigest()
    assert checked.where("ord = 8").first()["fingerprint"] == wanted
    picked = chat.sample_chats(checked, chat.ChatRules(sample=1)).collect()
    identifiers = ["a", hashlib.sha256(wanted.encode()).hexdigest()[:24]]
    assert picked[0]["identifier"] == min(identifiers, key=lambda i: hashlib.sha256(f"42:{i}".encode()).hexdigest())
    canon = [json.loads(r["row"]) for r in plan.canonical_chats(df, excluded).collect()]
    assert len(canon) == 2 and all(check_row(r) == [] for r in canon)


def test_tool_chats(spark):
    row = {
        "messages": [
            {"role": "developer", "content": " Use tools. "},
            {"role": "user", "content": "go"},
            {"role": "assistant", "tool_calls": [{"function": {"name": "probe", "arguments": '{"target": "edge7"}'}}, {"id": "z", "name": "probe", "arguments": {"target": "core3"}}]},
            {"role": "tool", "content": "ok"},
            {"role": "tool", "tool_call_id": "z", "content": "ok"},
            {"role": "other", "content": "dropped"},
        ],
        "tools": [{"function": TOOL}],
    }
    got = chat.convert_tool_chat(row, 0)
    assert got["system"] == "Use tools." and [t["role"] for t in got["turns"]] == ["user", "assistant", "tool", "tool"]
    assert [(t["call_id"], t["name"]) for t in got["turns"][2:]] == [("call_2_0", "probe"), ("z", "probe")]
    assert any("assistant response" in e for e in check_row(got))
    done = copy.deepcopy(row)
    done["messages"].append({"role": "assistant", "content": "done"})
    bad = copy.deepcopy(row)
    bad["messages"][2]["tool_calls"][0]["function"]["arguments"] = "{'target': 1}"
    rows = [("f1", 0, json.dumps(done)), ("f1", 1, json.dumps(row)), ("f2", 0, json.dumps(bad)), ("f2", 1, "[]")]
    df = chat.global_index(spark.createDataFrame(rows, "file string, n long, value string"), "file", "n")
    out = {(r["file"], r["n"]): r for r in chat.convert_tool_chats(df, split_col="file").collect()}
    assert [out[k]["reason"] for k in sorted(out)] == [None, "incomplete", "bad_arguments", "bad_row"] and out["f2", 1]["index"] == 3
    assert json.loads(out["f1", 0]["row"])["metadata"]["upstream_split"] == "f1"


def incident(events, **over):
    answer = json.dumps({"is_anomaly": True, "faulty_devices": ["edge7"], "root_cause_name": ["mtu"]})
    files = {"truth": answer, "submission": answer, "session": json.dumps({"task_description": "find", "scenario_name": "s"}), "log": "\n".join(json.dumps(e) for e in events)} | over
    return ("runs/link_faults/mtu_small/77", *(files[k] for k in ("truth", "submission", "session", "log")))


def start(name="probe", args="{'target': 'edge7'}"):
    return {"event": "tool_start", "tool": {"name": name, "description": "d"}, "input": args}


END = {"event": "llm_end", "generation_info": {"finish_reason": "stop"}, "text": "done"}
GOOD = [{"event": "llm_end", "generation_info": {"finish_reason": "tool_calls"}, "text": "look"}, start(), {"event": "tool_end", "output": "content='time\\'out' name='probe' id=1"}, END]


def test_incident():
    row = agent.convert_incident(*incident(GOOD), "sys")
    assert check_row(row) == [] and [t["role"] for t in row["turns"]] == ["user", "assistant", "tool", "assistant"]
    assert row["turns"][1]["content"] == "look" and row["turns"][2]["content"] == "time'out" and row["metadata"]["failure_type"] == "mtu_small" and row["id"] == "nika_77"
    assert row["tools"][0]["parameters"] == {"type": "object", "properties": {"target": {"type": "string"}}, "required": ["target"], "additionalProperties": False}


def test_parallel_results_out_of_order():
    log = [start(), start("dig", {"n": 1}), {"event": "tool_end", "output": "name='dig' x"}, {"event": "tool_end", "output": {"a": 1}}, END]
    row = agent.convert_incident(*incident(log), "sys")
    assert [(t["name"], t["call_id"], t["content"]) for t in row["turns"][2:4]] == [("dig", "call_1", "name='dig' x"), ("probe", "call_0", '{"a": 1}')] and len(row["turns"][1]["tool_calls"]) == 2


@pytest.mark.parametrize(
    "log,over,reason",
    [
        (GOOD, {"submission": None}, "missing_submission"),
        (GOOD, {"submission": '{"is_anomaly": false}'}, "incorrect_submission"),
        (GOOD, {"submission": "[]"}, "unreadable"),
        (GOOD, {"session": "{}"}, "missing_task_description"),
        (GOOD, {"log": "{}\nnope"}, "unreadable"),
        ([{"event": "llm_error"}], {}, "fatal_or_invalid_tool_event"),
        ([{"event": "llm_end", "invalid_tool_calls": [1]}], {}, "fatal_or_invalid_tool_event"),
        ([start(), END], {}, "assistant_before_tool_group_complete"),
        ([start(" ")], {}, "missing_tool_name"),
        ([start(args="{'a': }")], {}, "malformed_arguments"),
        ([start(args="[1]")], {}, "arguments_not_an_object"),
        ([{"event": "tool_end", "output": "x"}], {}, "tool_result_without_call"),
        ([start(), {"event": "tool_end", "output": " "}], {}, "empty_tool_output"),
        ([start(), {"event": "tool_end", "output": "x"}], {}, "incomplete_trajectory"),
        ([start()], {}, "incomplete_trajectory"),
    ],
)
def test_incident_reasons(log, over, reason):
    with pytest.raises(agent.Rejected) as e:
        agent.convert_incident(*incident(log, **over), "sys")
    assert str(e.value) == reason and reason in agent.REASONS


def test_incidents_from_files_to_merged_rows(spark, tmp_path):
    names = ("ground_truth.json", "submission.json", "session_meta.json", "conversation_diagnosis_agent.log")
    for k in range(5):
        d = tmp_path / "cat" / f"kind{k}" / f"i{k}"
        d.mkdir(parents=True)
        for n, text in zip(names, incident(GOOD)[1:]):
            if not (k == 4 and n == "submission.json"):
                (d / n).write_text(text)
    from tessera.sources.readers import read_whole_files

    got = agent.convert_incidents(agent.incidents(read_whole_files(spark, str(tmp_path))), "sys")
    assert {r["reason"]: r["count"] for r in got.groupBy("reason").count().collect()} == {None: 4, "missing_submission": 1}
    agents = got.where("reason is null").select(F.get_json_object("row", "$.id").alias("id"), F.lit("nika").alias("source"), "row")
    general = spark.createDataFrame([(f"g{i}", "general_sft", dumps(ROW | {"id": f"g{i}"})) for i in range(20)], "id string, source string, row string")
    tools = spark.createDataFrame([("t", "functiongemma_network", dumps(ROW | {"metadata": {"upstream_split": "test"}}))], "id string, source string, row string")
    merged = plan.split_and_merge(general, tools, agents).cache()
    m = plan.merge_manifest(merged)
    assert m["rows_by_source"]["general_sft"] == {"train": 18, "validation": 1, "test": 1} and m["rows_by_source"]["nika"] == {"train": 2, "validation": 1, "test": 1} and len(m["test_unseen_failure_types"]) == 1
    assert all(json.loads(r["row"])["metadata"]["split"] == r["split"] for r in merged.collect())
    assert {r["source"]: r["rows"] for r in plan.token_statistics(merged).collect()} == {"general_sft": 20, "functiongemma_network": 1, "nika": 4}


def test_tool_schema_table_equals_the_walk(spark):
    calls = [{"a": 1, "b": "x"}, {"a": True}, {"a": 2, "c": [1], "d": {"e": 1}}]
    df = spark.createDataFrame([("t", json.dumps(c), i) for i, c in enumerate(calls)], "tool string, args string, o int")
    got = agent.tool_schemas(df, "tool", "args", "o").collect()
    wanted = agent.infer_schema(calls)
    assert {r["key"]: {"type": r["type"]} for r in got} == wanted["properties"] and sorted(r["key"] for r in got if r["required"]) == wanted["required"]


def test_validation_reports(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(["", dumps(ROW | {"id": "1"}), " ", dumps(ROW | {"id": "2", "source": ""}), "[1]", dumps(ROW | {"id": "1"})]) + "\n")
    (tmp_path / "b.jsonl").write_text(dumps(ROW | {"id": "2"}) + "\n")
    paths = [str(tmp_path / n) for n in ("a.jsonl", "none.jsonl", "b.jsonl")]
    report = plan.validate_files(spark, paths, str(tmp_path / "r"), strict=False)
    assert report == {"files": paths, "rows": 5, "rows_by_source": {"s": 3, "unknown": 2}, "invalid_rows": 5}
    got = {(r["file"], r["row_number"]): (r["id"], r["errors"]) for r in spark.read.schema("file string, row_number long, id string, errors array<string>").json(str(tmp_path / "r" / "validation_errors.jsonl")).collect()}
    assert got[paths[1], None] == (None, ["file does not exist"]) and got[paths[0], 4] == ("1", [f"duplicate id; first seen in {paths[0]}"])
    assert got[paths[2], 1] == ("2", [f"duplicate id; first seen in {paths[0]}"]) and got[paths[0], 3] == (None, ["row is not an object"]) and "id/source" in got[paths[0], 2][1][0]
    assert json.load(open(tmp_path / "r" / "validation_summary.json"))["invalid_rows"] == 5
    with pytest.raises(RuntimeError, match="5 invalid rows"):
        plan.validate_files(spark, paths, str(tmp_path / "r"))


def test_whole_run(spark, tmp_path):
    chats = spark.createDataFrame([(f"p{i}", [("user", f"question {i}"), ("assistant", "answer")], i) for i in range(24)] + [("bad", [("user", "x")], 99)], f"prompt_id string, messages {chat.MESSAGES}, ord long")
    row = {"messages": [{"role": "user", "content": "go"}, {"role": "assistant", "content": "done"}], "tools": [{"function": TOOL}]}
    tools = spark.createDataFrame([(json.dumps(row), 0, "test"), (json.dumps({"messages": row["messages"][:1]}), 1, "train")], "value string, index long, file string")
    gathered = spark.createDataFrame([(f"a/b/kind{k}/i{k}", *incident(GOOD)[1:]) for k in range(4)] + [("a/b/c/d", *incident(GOOD, submission=None)[1:])], "dir string, truth string, submission string, session string, log string")
    done = plan.run(str(tmp_path / "out"), chats, tools, gathered, system="sys")
    assert done["general_sft"] == {"input_rows_seen": 25, "output_rows": 24, "rejected": {"empty_or_bad_role_sequence": 1}}
    assert done["functiongemma_network"] == {"input_rows": 2, "output_rows": 1, "rejected": {"incomplete": 1}}
    assert done["nika"] == {"incidents": 5, "output_rows": 4, "rejected": {"missing_submission": 1}}
    assert done["merge"]["rows"] == done["statistics"]["splits"] and sum(done["merge"]["rows"].values()) == 29 == done["validate_canonical"]["rows"]
    for split, n in done["merge"]["rows"].items():
        lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out" / "canonical" / f"{split}.jsonl")).collect()]
        assert len(lines) == n and {x["metadata"]["split"] for x in lines} <= {split}
        keys = [__import__("hashlib").sha256(f"42:{split}:{x['id']}".encode()).hexdigest() for x in lines]
        assert keys == sorted(keys)
    assert json.load(open(tmp_path / "out" / "reports" / "nika.json"))["output_rows"] == 4
