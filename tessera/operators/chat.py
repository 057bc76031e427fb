"""Chats: cleaning of message lists, exact deduplication, repeatable samples, tool-call rows."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.text import seeded_hash, stable_id, strip, truthy
from tessera.functions.values import parse_arguments
from tessera.operators.canonical import canonical_row, check_row, dumps
from tessera.operators.cleaning import keep_first

MESSAGES = "array<struct<role:string,content:string>>"


def clean_messages(messages: Column) -> Column:
    """User and assistant messages, stripped; null unless they alternate from user to assistant and none is empty."""
    spoken = F.filter(messages, lambda m: m["role"].isin("user", "assistant"))
    kept = F.transform(spoken, lambda m: F.struct(m["role"].alias("role"), strip(F.coalesce(m["content"], F.lit(""))).alias("content")))
    wrong = F.filter(kept, lambda m, i: (m["content"] == "") | (m["role"] != F.when(i % 2 == 0, "user").otherwise("assistant")))
    return F.when((F.size(kept) > 0) & (F.size(kept) % 2 == 0) & (F.size(wrong) == 0), kept)


def _quoted(text: Column) -> Column:
    """A JSON string. Control characters are written with capital hexadecimal digits."""
    whole = F.to_json(F.struct(text.alias("c")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def messages_json(messages: Column) -> Column:
    """JSON text with sorted keys, ", " and ": " between items."""
    return F.concat(F.lit("["), F.array_join(F.transform(messages, lambda m: F.concat(F.lit('{"content": '), _quoted(m["content"]), F.lit(', "role": "'), m["role"], F.lit('"}'))), ", "), F.lit("]"))


def assemble_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """One row for each conversation, with its messages in order."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(turn_col).alias("t"), F.col("role").alias("role"), F.col("text").alias("content"))))
    return turns.groupBy(id_col).agg(F.transform(parts, lambda p: F.struct(p["role"].alias("role"), p["content"].alias("content"))).alias("messages"))


@dataclass(frozen=True)
class ChatRules:
    max_chars: int = 32_000
    sample: int = 2_000
    seed: int = 42


def check_chats(chats: DataFrame, excluded: DataFrame | None = None, rules: ChatRules | None = None) -> DataFrame:
    """chats (prompt_id, messages, ord) with cleaned messages, their fingerprint and the reason for which they are rejected.

    Reasons in order: reserved_for_cpt, empty_or_bad_role_sequence, overly_long, exact_duplicate.
    """
    rules = rules or ChatRules()
    marked = chats.withColumn("prompt_id", F.col("prompt_id").cast("string"))
    if excluded is not None:
        ids = excluded.select(strip(F.col(excluded.columns[0]).cast("string")).alias("prompt_id")).where("prompt_id <> ''").distinct().withColumn("_reserved", F.lit(True))
        marked = marked.join(ids, "prompt_id", "left")
    else:
        marked = marked.withColumn("_reserved", F.lit(None).cast("boolean"))
    cleaned = marked.withColumn("messages", clean_messages(F.col("messages"))).withColumn("_json", messages_json(F.col("messages")))
    first = (
        F.when(F.col("_reserved"), "reserved_for_cpt")
        .when(F.col("messages").isNull(), "empty_or_bad_role_sequence")
        .when(F.length("_json") > rules.max_chars, "overly_long")
    )
    judged = cleaned.withColumns({"reason": first, "fingerprint": F.sha2("_json", 256)}).drop("_json", "_reserved")
    good = judged.where("reason is null").groupBy("fingerprint").agg(F.min("ord").alias("_first"))
    # rejected chats, many of them without a fingerprint, go past the join
    joined = judged.where("reason is null").join(good, "fingerprint")
    told = joined.withColumn("reason", F.when(F.col("ord") != F.col("_first"), "exact_duplicate")).drop("_first")
    return told.unionByName(judged.where("reason is not null"))


def sample_chats(checked: DataFrame, rules: ChatRules | None = None) -> DataFrame:
    """The accepted chats with the smallest hashes: id, identifier, messages, fingerprint."""
    rules = rules or ChatRules()
    identifier = F.coalesce(truthy(F.col("prompt_id")), stable_id(F.col("fingerprint")))
    good = checked.where("reason is null").select(identifier.alias("identifier"), "messages", "fingerprint", "ord")
    # order and limit together: each task keeps its best rows only
    best = good.withColumn("hash", seeded_hash(F.col("identifier"), rules.seed)).orderBy("hash", "ord").limit(rules.sample)
    return best.select(F.concat(F.lit("general_"), stable_id(F.col("identifier"))).alias("id"), "identifier", "messages", "fingerprint", "hash")


def dedup_chats(checked: DataFrame) -> DataFrame:
    """The first chat of every fingerprint, without the others' reasons."""
    return keep_first(checked.where("reason is null or reason = 'exact_duplicate'"), "fingerprint", "ord")


# --- tool-call rows ---------------------------------------------------------------------------

TOOL_SOURCE = {"source": "functiongemma_network", "task": "simple_network_tool", "prefix": "functiongemma_"}


def global_index(rows: DataFrame, file_col: str, row_col: str) -> DataFrame:
    """rows with index: their number over all files in file order. row_col numbers a file's rows from 0."""
    sizes = rows.groupBy(file_col).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(file_col).rowsBetween(Window.unboundedPreceding, -1)
    # as many rows as there are files
    offsets = sizes.select(file_col, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return rows.join(offsets, file_col).withColumn("index", F.col("_offset") + F.col(row_col)).drop("_offset")


class ToolChat:
    """Turns a provider's tool-call messages into canonical turns; results without an id answer the calls in order."""

    def __init__(self) -> None:
        self.system: list[str] = []
        self.turns: list[dict[str, Any]] = []
        self.asked: list[tuple[str, str]] = []
        self.results = 0

    def add(self, number: int, message: dict[str, Any]) -> None:
        handler: Callable | None = {"developer": self._head, "system": self._head, "assistant": self._assistant, "tool": self._tool, "user": self._user}.get(message.get("role"))
        if handler:
            handler(number, message, str(message.get("content") or ""))

    def _head(self, number: int, message: dict, content: str) -> None:
        if content.strip():
            self.system.append(content.strip())

    def _user(self, number: int, message: dict, content: str) -> None:
        self.turns.append({"role": "user", "content": content})

    def _assistant(self, number: int, message: dict, content: str) -> None:
        calls = []
        for k, call in enumerate(message.get("tool_calls") or []):
            inner = call.get("function") or call
            id_ = str(call.get("id") or f"call_{number}_{k}")
            calls.append({"call_id": id_, "name": str(inner.get("name") or ""), "arguments": _object(inner.get("arguments") or {})})
        self.asked += [(c["call_id"], c["name"]) for c in calls]
        self.turns.append({"role": "assistant", "content": content} | ({"tool_calls": calls} if calls else {}))

    def _tool(self, number: int, message: dict, content: str) -> None:
        nth = self.asked[self.results][0] if self.results < len(self.asked) else ""
        self.results += 1
        id_ = str(message.get("tool_call_id") or nth)
        # the latest call of an id names the tool
        name = message.get("name") or dict(self.asked).get(id_) or ""
        self.turns.append({"role": "tool", "call_id": id_, "name": str(name), "content": content})


def _object(value: Any) -> dict:
    """Arguments here are objects or JSON text of one."""
    if isinstance(value, str):
        json.loads(value)
    return parse_arguments(value)


def convert_tool_chat(row: dict[str, Any], index: int, original: str = "") -> dict[str, Any]:
    """A canonical row; its id depends on the row's number and its turns."""
    chat = ToolChat()
    for number, message in enumerate(row.get("messages") or []):
        chat.add(number, message)
    tools = [{"name": str(f.get("name") or ""), "description": str(f.get("description") or ""), "parameters": f.get("parameters") or {}} for t in row.get("tools") or [] for f in [t.get("function") or t]]
    digest = hashlib.sha256(f"{index}\x1f{dumps(chat.turns)}".encode()).hexdigest()[:24]
    meta = {"original_source": original, "module_id": str(row.get("module_id") or ""), "upstream_split": str(row.get("split") or "train")}
    return canonical_row(TOOL_SOURCE["prefix"] + digest, TOOL_SOURCE["source"], TOOL_SOURCE["task"], "\n\n".join(chat.system), tools, chat.turns, meta)


def convert_tool_chats(rows: DataFrame, json_col: str = "value", index_col: str = "index", split_col: str | None = None, original: str = "") -> DataFrame:
    """rows with row (canonical JSON) or reason: bad_arguments, bad_row, incomplete. Bad rows stop nothing."""

    @F.pandas_udf("row string, reason string")
    def convert(texts: pd.Series, index: pd.Series, split: pd.Series) -> pd.DataFrame:
        out = []
        for t, i, s in zip(texts, index, split):
            try:
                source = json.loads(t)
                source.setdefault("split", s)
                row = convert_tool_chat(source, int(i), original)
                out.append((dumps(row), "incomplete" if check_row(row) else None))
            except ValueError:
                out.append((None, "bad_arguments"))
            except (AttributeError, TypeError):
                out.append((None, "bad_row"))
        return pd.DataFrame(out, columns=["row", "reason"])

    stem = F.col(split_col) if split_col else F.lit("train")
    return rows.withColumn("_c", convert(F.col(json_col), F.col(index_col), stem)).select(*rows.columns, "_c.row", "_c.reason")
