"""The canonical conversation row and the check of its rules.

A row is an object: id, source, task_type, system, tools, turns, metadata. The parts that are the same in every
row could be columns, but parameters, arguments and metadata are free objects, so rows travel as JSON text and a checker
walks one row at a time: whether a call is open depends on all turns before.
"""

from __future__ import annotations

import json
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# Fixed values of the row format.
COLUMNS = ("id", "source", "task_type", "system", "tools", "turns", "metadata")
ROLES = ("user", "assistant", "tool")
MODEL_TOKENS = ("<|start_header_id|>", "<|eot_id|>", "<tool_call>", "<start_of_turn>")


def canonical_row(id_: str, source: str, task_type: str, system: str, tools: list, turns: list, metadata: dict | None = None) -> dict[str, Any]:
    return dict(zip(COLUMNS, (id_, source, task_type, system, tools, turns, metadata or {})))


def dumps(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True)


def _marked(text: Any) -> bool:
    return isinstance(text, str) and any(t in text for t in MODEL_TOKENS)


def _blank(value: Any) -> bool:
    return not str(value or "").strip()


class RowChecker:
    """Collects a row's errors; the ledger of open calls maps call ids to tool names."""

    def __init__(self, row: dict[str, Any]) -> None:
        self.row, self.errors = row, []
        self.tools: set[str] = set()
        self.ledger: dict[str, str] = {}
        self.answered = False
        self.last: str | None = None

    def check(self) -> list[str]:
        absent = sorted(set(COLUMNS) - set(self.row))
        if absent:
            return [f"missing columns: {absent}"]
        self._head()
        if not isinstance(self.row["tools"], list):
            return [*self.errors, "tools must be a list"]
        for k, tool in enumerate(self.row["tools"]):
            self._tool(f"tools[{k}]", tool)
        turns = self.row["turns"]
        if not isinstance(turns, list) or not turns:
            return [*self.errors, "turns must be a non-empty list"]
        # a first or last turn that is no object has no role; it is reported below
        role_of = lambda t: t.get("role") if isinstance(t, dict) else None
        self._say(role_of(turns[0]) != "user", "first turn must be user")
        for k, turn in enumerate(turns):
            self._turn(f"turns[{k}]", turn)
        self._say(self.ledger, f"missing tool results for {sorted(self.ledger)}")
        self._say(not self.answered, "at least one non-empty assistant response is required")
        self._say(role_of(turns[-1]) != "assistant", "conversation must end with assistant")
        return self.errors

    def _say(self, wrong: Any, message: str) -> bool:
        if wrong:
            self.errors.append(message)
        return bool(wrong)

    def _head(self) -> None:
        row = self.row
        self._say(not (row["id"] and row["source"] and row["task_type"]), "id/source/task_type must be non-empty")
        if not self._say(not isinstance(row["system"], str), "system must be a string"):
            self._say(_marked(row["system"]), "system contains a model-specific token")
        self._say(not isinstance(row["metadata"], dict), "metadata must be an object")

    def _tool(self, at: str, tool: Any) -> None:
        if self._say(not isinstance(tool, dict), f"{at} is not an object"):
            return
        name = str(tool.get("name") or "")
        self._say(not name or name in self.tools, f"{at} has missing/duplicate name")
        self.tools.add(name)
        self._say(not isinstance(tool.get("description", ""), str), f"{at}.description must be a string")
        self._say(not isinstance(tool.get("parameters"), dict), f"{at}.parameters must be an object")

    def _turn(self, at: str, turn: Any) -> None:
        if self._say(not isinstance(turn, dict), f"{at} is not an object"):
            return
        role, content, calls = turn.get("role"), turn.get("content"), turn.get("tool_calls") or []
        if self._say(role not in ROLES, f"{at} has invalid role {role!r}"):
            return
        waiting = bool(self.ledger)
        self._say(_marked(content), f"{at} contains a model-specific token")
        if role == "assistant":
            self._say(waiting, f"{at} assistant appears before tool results")
            self.answered |= not _blank(content)
            self._say(_blank(content) and not calls, f"{at} assistant is empty")
            for k, call in enumerate(calls):
                self._call(at, k, call)
        else:
            if role == "user":
                self._say(_blank(content), f"{at} has empty user content")
                self._say(waiting, f"{at} user appears before tool results")
            self._say(calls, f"{at} only assistant may contain tool_calls")
        if role == "tool":
            self._result(at, turn, content)
        elif self.last == "tool":
            if not self._say(waiting, f"{at} interrupts a tool-result group"):
                self._say(role != "assistant", f"{at} must be assistant after tool results")
        self.last = role

    def _call(self, at: str, k: int, call: Any) -> None:
        if self._say(not isinstance(call, dict), f"{at}.tool_calls[{k}] is not an object"):
            return
        id_, name = str(call.get("call_id") or ""), str(call.get("name") or "")
        bad = (
            self._say(not id_ or id_ in self.ledger, f"{at} has missing/duplicate call_id")
            or self._say(not name or name not in self.tools, f"{at} references unknown tool {name!r}")
            or self._say(not isinstance(call.get("arguments"), dict), f"{at} tool arguments must be an object")
        )
        if not bad:
            self.ledger[id_] = name

    def _result(self, at: str, turn: dict, content: Any) -> None:
        id_ = str(turn.get("call_id") or "")
        if not self._say(id_ not in self.ledger, f"{at} has unmatched call_id {id_!r}"):
            self._say(str(turn.get("name") or "") != self.ledger.pop(id_), f"{at} tool name does not match its call")
        self._say(content is None or not str(content).strip(), f"{at} has empty tool output")


def check_row(row: dict[str, Any]) -> list[str]:
    return RowChecker(row).check()


@F.pandas_udf(ArrayType(StringType()))
def row_errors(rows: pd.Series) -> pd.Series:
    """The errors of canonical rows in JSON text; text that is no object is one error."""

    def one(text: str | None) -> list[str]:
        try:
            row = json.loads(text or "")
        except json.JSONDecodeError:
            return ["row is not valid JSON"]
        return check_row(row) if isinstance(row, dict) else ["row is not an object"]

    return rows.map(one)


def validate(rows: DataFrame, json_col: str = "row", file_col: str | None = None) -> DataFrame:
    """rows with id, errors and duplicate_of: the file that had the same id first (by file, then order), if any."""
    out = rows.withColumn("errors", row_errors(F.col(json_col))).withColumn("id", F.get_json_object(json_col, "$.id"))
    if file_col is None:
        return out
    first = out.where("id is not null and id <> ''").groupBy("id").agg(F.min(F.struct(file_col, "ord")).alias("_first"))
    joined = out.join(first, "id", "left")
    later = F.col("_first").isNotNull() & ~((F.col("_first.ord") == F.col("ord")) & (F.col(f"_first.{file_col}") == F.col(file_col)))
    return joined.withColumn("duplicate_of", F.when(later, F.col(f"_first.{file_col}"))).drop("_first")


def validation_summary(validated: DataFrame, source_col: str = "source") -> DataFrame:
    """Rows, rows with errors and errors for each source."""
    n = F.size("errors") + (F.col("duplicate_of").isNotNull().cast("int") if "duplicate_of" in validated.columns else F.lit(0))
    return validated.groupBy(source_col).agg(F.count(F.lit(1)).alias("rows"), F.sum((n > 0).cast("long")).alias("bad_rows"), F.sum(n.cast("long")).alias("errors"))


def render(row: dict[str, Any]) -> tuple[list[dict[str, Any]], list[dict[str, Any]]]:
    """(messages, tools) as chat templates take them. The only place that adds wrappers."""

    def message(turn: dict) -> dict:
        if turn["role"] == "tool":
            return {"role": "tool", "name": turn["name"], "tool_call_id": turn["call_id"], "content": turn["content"]}
        out = {"role": turn["role"], "content": turn.get("content", "")}
        if turn["role"] == "assistant" and turn.get("tool_calls"):
            out["tool_calls"] = [{"id": c["call_id"], "type": "function", "function": {k: c[k] for k in ("name", "arguments")}} for c in turn["tool_calls"]]
        return out

    head = [{"role": "system", "content": row["system"]}] if row["system"] else []
    tools = [{"type": "function", "function": {"name": t["name"], "description": t.get("description", ""), "parameters": t["parameters"]}} for t in row["tools"]]
    return head + [message(t) for t in row["turns"]], tools


#: The model families' renderers; all take the common form.
RENDERERS = {"hf": render, "llama": render, "qwen": render, "gemma": render}


@F.pandas_udf(StructType([StructField("messages", StringType()), StructField("tools", StringType())]))
def rendered(rows: pd.Series) -> pd.DataFrame:
    """messages and tools of canonical rows in JSON text; nulls where there is no row."""
    both = [(None, None) if r is None else tuple(map(dumps, render(json.loads(r)))) for r in rows]
    return pd.DataFrame(both, columns=["messages", "tools"], dtype=object)
