"""Agent traces: one incident's event log becomes one canonical conversation.

Which result belongs to which call depends on all events before, so each incident is walked in Python; incidents are
independent rows, and a bad one gives a reason instead of stopping the run.
"""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.values import parse_arguments, string_set
from tessera.operators.canonical import canonical_row, dumps

# Fixed values of the log format.
FAILED_EVENTS = frozenset({"chain_error", "llm_error", "tool_error", "fatal_error"})
RESULT_NAME = re.compile(r"""\bname=['"]([^'"]+)['"]""")
RESULT_CONTENT = re.compile(r"""^content=('(?:\\.|[^'])*'|"(?:\\.|[^"])*")""", re.DOTALL)
AGENT = {"source": "nika", "task": "network_agent", "prefix": "nika_", "origin": "NIKA Traces v1 / Zenodo 17971675"}
ANSWER = ("is_anomaly", "faulty_devices", "root_cause_name")
REASONS = ("missing_submission", "unreadable", "incorrect_submission", "missing_task_description", "fatal_or_invalid_tool_event", "assistant_before_tool_group_complete", "missing_tool_name", "malformed_arguments", "arguments_not_an_object", "tool_result_without_call", "empty_tool_output", "incomplete_trajectory")


class Rejected(ValueError):
    """A reason of REASONS."""


def same_answer(truth: dict, given: dict) -> bool:
    flag, *sets = ANSWER
    return truth.get(flag) == given.get(flag) and all(string_set(truth.get(k)) == string_set(given.get(k)) for k in sets)


def output_text(value: Any) -> str:
    """A tool's output: the content of a printed message object, other text as it is, other values as JSON."""
    if not isinstance(value, str):
        return dumps(value)
    m = RESULT_CONTENT.match(value)
    if m:
        try:
            return str(ast.literal_eval(m[1]))
        except (SyntaxError, ValueError):
            pass
    return value


def type_name(value: Any) -> str:
    for kinds, name in ((bool, "boolean"), ((int, float), "number"), (list, "array"), (dict, "object")):
        if isinstance(value, kinds):
            return name
    return "string"


class Trace:
    """A walk over events: turns so far, and the open calls of the current group.

    A group of calls is open until its results are in. Its calls are written as one turn when the first result comes, so
    `written` says whether that has happened.
    """

    def __init__(self, task: str) -> None:
        self.turns: list[dict[str, Any]] = [{"role": "user", "content": task}]
        self.open: list[dict[str, Any]] = []
        self.written = 0  # how many of the open calls stand in a turn
        self.lead = ""
        self.tools: dict[str, tuple[str, list[dict]]] = {}
        self.handlers = {"llm_end": self._on_text, "tool_start": self._on_call, "tool_end": self._on_result}

    def event(self, e: dict[str, Any]) -> None:
        if e.get("event") in FAILED_EVENTS or e.get("invalid_tool_calls"):
            raise Rejected("fatal_or_invalid_tool_event")
        handle = self.handlers.get(e.get("event"))
        if handle:
            handle(e)

    def _on_text(self, e: dict[str, Any]) -> None:
        text = str(e.get("text") or "").strip()
        before_calls = (e.get("generation_info") or {}).get("finish_reason") == "tool_calls"
        self.lead = text if before_calls else self.lead
        if text and not before_calls:
            if self.open:
                raise Rejected("assistant_before_tool_group_complete")
            self.turns.append({"role": "assistant", "content": text})

    def _on_call(self, e: dict[str, Any]) -> None:
        about = e.get("tool") or {}
        name = str(about.get("name") or "").strip()
        if not name:
            raise Rejected("missing_tool_name")
        try:
            given = parse_arguments(e.get("input") or {})
        except ValueError as wrong:
            raise Rejected(str(wrong)) from wrong
        number = sum(len(calls) for _, calls in self.tools.values())
        self.tools.setdefault(name, (str(about.get("description") or ""), []))[1].append(given)
        self.open.append({"call_id": f"call_{number}", "name": name, "arguments": given})

    def _on_result(self, e: dict[str, Any]) -> None:
        output = e.get("output")
        if len(self.open) > self.written:
            self.turns.append({"role": "assistant", "content": self.lead, "tool_calls": self.open[self.written :]})
            self.lead = ""
        if not self.open:
            raise Rejected("tool_result_without_call")
        call = self.open.pop(self._answered(output))
        self.written = len(self.open)
        content = output_text(output)
        if not content.strip():
            raise Rejected("empty_tool_output")
        self.turns.append({"role": "tool", "call_id": call["call_id"], "name": call["name"], "content": content})

    def _answered(self, output: Any) -> int:
        """Which open call a result belongs to: the oldest one of the tool it names, else the oldest."""
        m = RESULT_NAME.search(output) if isinstance(output, str) else None
        names = [c["name"] for c in self.open]
        return names.index(m[1]) if m and m[1] in names else 0

    def finished(self) -> list[dict[str, Any]]:
        if self.open or self.turns[-1]["role"] != "assistant":
            raise Rejected("incomplete_trajectory")
        return self.turns

    def schemas(self) -> list[dict[str, Any]]:
        return [{"name": n, "description": self.tools[n][0], "parameters": infer_schema(self.tools[n][1])} for n in sorted(self.tools)]


def infer_schema(calls: list[dict]) -> dict[str, Any]:
    """A tool's parameters from its calls: all keys, those of every call required, types from the first call that has them."""
    first: dict[str, Any] = {}
    for c in calls:
        first = c | first
    always = [k for k in first if all(k in c for c in calls)]
    return {"type": "object", "properties": {k: {"type": type_name(first[k])} for k in sorted(first)}, "required": sorted(always), "additionalProperties": False}


def _object(text: str | None) -> dict:
    try:
        value = json.loads(text or "")
    except json.JSONDecodeError as e:
        raise Rejected("unreadable") from e
    if not isinstance(value, dict):
        raise Rejected("unreadable")
    return value


def convert_incident(path: str, truth: str | None, submission: str | None, session: str | None, log: str | None, system: str) -> dict[str, Any]:
    """A canonical row of an incident's four files; path ends in category/failure type/incident."""
    if submission is None:
        raise Rejected("missing_submission")
    right = _object(truth)
    if not same_answer(right, _object(submission)):
        raise Rejected("incorrect_submission")
    about = _object(session)
    task = str(about.get("task_description") or "").strip()
    if not task:
        raise Rejected("missing_task_description")
    trace = Trace(task)
    if log is None:
        raise Rejected("unreadable")
    for line in log.splitlines():
        if line.strip():
            trace.event(_object(line))
    turns = trace.finished()
    category, failure, incident = path.rstrip("/").split("/")[-3:]
    meta = {
        "failure_type": failure, "issue_category": category, "incident_id": incident, "success": True, "original_source": AGENT["origin"],
        "is_anomaly": bool(right.get("is_anomaly")), "faulty_devices": sorted(string_set(right.get("faulty_devices"))), "root_cause_name": sorted(string_set(right.get("root_cause_name"))),
        "scenario": str(about.get("scenario_name") or ""), "backend_model": str(about.get("backend_model") or ""), "scenario_topo_size": str(about.get("scenario_topo_size") or ""),
    }
    return canonical_row(AGENT["prefix"] + incident, AGENT["source"], AGENT["task"], system, trace.schemas(), turns, meta)


def incidents(files: DataFrame, path_col: str = "path", text_col: str = "value") -> DataFrame:
    """One row for each incident folder from its files: dir, truth, submission, session, log."""
    name = F.element_at(F.split(path_col, "/"), -1)
    named = files.withColumns({"dir": F.regexp_replace(path_col, "/[^/]*$", ""), "name": name})
    one = lambda n: F.max(F.when(F.col("name") == n, F.col(text_col)))
    gathered = named.groupBy("dir").agg(one("ground_truth.json").alias("truth"), one("submission.json").alias("submission"), one("session_meta.json").alias("session"), one("conversation_diagnosis_agent.log").alias("log"))
    return gathered.where("truth is not null")


def convert_incidents(gathered: DataFrame, system: str) -> DataFrame:
    """dir, row (canonical JSON), failure_type, reason of every incident."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for d, truth, submission, session, log in zip(b["dir"], b["truth"], b["submission"], b["session"], b["log"]):
                try:
                    row = convert_incident(d, truth, submission, session, log, system)
                    out.append((d, dumps(row), row["metadata"]["failure_type"], None))
                except Rejected as e:
                    out.append((d, None, None, str(e)))
            yield pd.DataFrame(out, columns=["dir", "row", "failure_type", "reason"])

    return gathered.select("dir", "truth", "submission", "session", "log").mapInPandas(run, "dir string, row string, failure_type string, reason string")


def tool_schemas(calls: DataFrame, tool_col: str, args_col: str, ord_col: str) -> DataFrame:
    """The same inference over a table of calls: tool, key, type, required. Aggregations only, so no tool's calls meet in one task."""
    from tessera.functions.values import json_type

    total = calls.groupBy(F.col(tool_col).alias("tool")).agg(F.count(F.lit(1)).alias("calls"))
    args = calls.select(F.col(tool_col).alias("tool"), F.col(ord_col).alias("o"), F.col(args_col).alias("a"), F.explode(F.json_object_keys(args_col)).alias("key"))
    typed = args.withColumn("t", json_type(F.to_json(F.expr("try_variant_get(try_parse_json(a), concat('$[\"', key, '\"]'), 'variant')"))))
    keys = typed.groupBy("tool", "key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("o", "t")).alias("first"))
    return keys.join(total, "tool").select("tool", "key", F.col("first.t").alias("type"), (F.col("n") == F.col("calls")).alias("required"))
