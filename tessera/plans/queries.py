"""Registered queries over the driver's tables, and the same in DuckDB SQL.

documents stand for one-section records (document = doc_id, ord = doc_id, a license for all), conversations for documents
with a section for each turn, event types for groups that are held out together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.quality import rejection_reason
from tessera.functions.values import json_type, metadata_object
from tessera.operators import agent, canonical, chat, cleaning, sections, splits, stats
from tessera.sources.scratch import keep

SEED = 42
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents for work on whole texts: a table of fewer splits than there are cores is dealt to all of them."""
    d = _read(spark, sf_dir, "documents")
    cores = spark.sparkContext.defaultParallelism
    return d.repartition(cores) if d.rdd.getNumPartitions() < cores else d


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as records of the corpus."""
    d = _texts(spark, sf_dir)
    doc = F.col("doc_id").cast("string")
    return d.select(
        T.stable_id(F.col("source"), doc).alias("id"), "source", doc.alias("document"), doc.alias("title"), F.lit("CC").alias("license"), F.col("lang").alias("language"), "text", F.lit("").alias("snapshot"),
        F.lit("").alias("section"), F.lit(0).cast("long").alias("estimated_tokens"), F.lit("{}").alias("metadata"), F.col("doc_id").alias("ord"),
    )


def with_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as records, and the literal ones."""
    d = documents(spark, sf_dir)
    more = spark.createDataFrame(LITERALS, "ord long, license string, text string")
    return d.unionByName(more.select(*[F.col(c) if c in more.columns else F.lit("-" if c == "source" else None).cast(d.schema[c].dataType).alias(c) for c in d.columns]))


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as chats, one row each."""
    return chat.assemble_chats(_read(spark, sf_dir, "conversations")).select(F.col("conv_id").cast("string").alias("prompt_id"), "messages", F.col("conv_id").alias("ord"))


_PROSE = "Routers keep tables of prefixes and pass packets to the next hop, which does the same again. " * 3
#: Records that the tables have none of: (doc_id, license, text). Every line rule and every reason occurs.
LITERALS = [
    (-1, "CC", "  Table Of Contents \nfirst\r\n   kept indent \t\rPREVIOUS\n\n\n\n\n\nnext\nSkip to content\nskip to main content\nEdit on GitHub\nnext hop\nlast  \n\n"),
    (-2, "CC", "Chapter one ........ 12\nA.....3\nab.....\n.....7\n©copyright all\n©   Copyright 2020 by all\n ©\tCOPYRIGHT\n© copyrighted\ncopyright ©"),
    (-3, "CC", "a\x01b\x0bc\x7f d\x85e\u2028f\u2029g\xa0\nh\u3000\ne\u0301 café \u212b"),
    (-4, "CC", " \n\t\n "),
    (-5, "CC", "next"),
    (-6, "", _PROSE),
    (-7, " \t", _PROSE),
    (-8, "CC", "https://example.net/a/long/path/to/some/page HTTP://example.org/?q=1\n" * 4),
    (-9, "CC", "https://example.net/a/long/path/to/some/page and\n" * 5),
    (-10, "CC", _PROSE + "\n" + "=" * 16 + "\n"),
    (-11, "CC", _PROSE + "\n" + "=" * 15 + "\n" + "_" * 20 + "é" * 16),
    (-12, "CC", _PROSE + "\ufffd" * 9),
    (-13, "CC", _PROSE + "\ufffd" * 2),
    (-14, "CC", "+- */ ab; " * 30),
    (-15, "CC", "+-*/; a. " * 30),
    (-16, "CC", "too short"),
]


def _sql_text(x: str) -> str:
    """A string for SQL, other than printable ASCII characters by number."""
    return " || ".join("'" + c.replace("'", "''") + "'" if c.isprintable() and c.isascii() else f"chr({ord(c)})" for c in _runs(x)) or "''"


def _runs(x: str) -> list[str]:
    out: list[str] = []
    for c in x:
        plain = c.isascii() and c.isprintable()
        if plain and out and out[-1].isascii() and out[-1].isprintable():
            out[-1] += c
        else:
            out.append(c)
    return out


# SQL that several queries share. White space that a text of the tables may hold.
_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_STRIP = lambda x: rf"regexp_replace(regexp_replace({x}, '^{_WS}+', ''), '{_WS}+$', '')"
_LEADER = r"^.{2,100}\.{5,}\s*\d+\s*$"
_BOILER = r"(?i)^(table of contents|skip to (main )?content|previous|next|edit on github)$|^©\s*copyright\b"
_LINES = r"string_split_regex(regexp_replace(nfc_normalize(regexp_replace(text, '\r\n?', chr(10), 'g')), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g'), '[\n\x{85}\x{2028}\x{2029}]')"
_NORMAL = f"""{_STRIP(f"regexp_replace(array_to_string(list_transform(list_filter({_LINES}, lambda x: not regexp_matches({_STRIP('x')}, '{_LEADER}') and not regexp_matches({_STRIP('x')}, '{_BOILER}')), lambda x: regexp_replace(x, '{_WS}+$', '')), chr(10)), '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g')")}"""
_FOLD = lambda x: _STRIP(rf"regexp_replace(replace(lower({x}), 'ß', 'ss'), '{_WS}+', ' ', 'g')")
_ALNUM = r"length(t) - length(regexp_replace(t, '[\p{L}\p{N}]', '', 'g'))"
_REASON = rf"""case when length(t) < 200 then 'too_short'
  when {_STRIP('license')} = '' then 'missing_license'
  when len(list_filter(string_split_regex({_STRIP('t')}, '{_WS}+'), lambda k: not regexp_matches(k, '(?i)^https?://.'))) = 0 then 'url_only'
  when len(list_filter(list_distinct(string_split(t, '')), lambda k: not regexp_matches(k, '[\p{{L}}\p{{N}}_\s\p{{Z}}]') and contains(t, repeat(k, 16)))) > 0 then 'repeated_punctuation'
  when (length(t) - length(replace(t, chr(65533), ''))) / greatest(1, length(t))::double > 0.01 then 'too_many_replacement_chars'
  when ({_ALNUM}) / greatest(1, length(t))::double < 0.2 then 'low_alnum_ratio' end"""
_TABLE = "select doc_id, source, 'CC' as license, text from documents"
_MORE = f"{_TABLE} union all select * from (values {', '.join(f'({i}, chr(45), {_sql_text(l)}, {_sql_text(t)})' for i, l, t in LITERALS)}) as v(doc_id, source, license, text)"
_JUDGED = lambda of: f"with i as ({of}), n as (select doc_id, source, license, {_NORMAL} as t from i), c as (select *, {_REASON} as reason from n)"
_CHECKED = _JUDGED(_TABLE)
_TOKENS = lambda x: f"cast(greatest(1, round_even(length({x}) / 4.0::double, 0)) as bigint)"
_ACCEPTED = f"{_CHECKED}, f as (select *, sha256({_FOLD('t')}) as fp from c where reason is null), a as (select *, row_number() over (partition by fp order by doc_id) as k from f)"


def _shares(of: str, by: str, key: str, name: str) -> str:
    """Largest remainders for 0.9, 0.05, 0.05, as common table expressions ending in s(by, name, split)."""
    return f"""r as (select {by}, {name}, row_number() over (partition by {by} order by sha256({key})) as rn, count(*) over (partition by {by}) as n from {of}),
q as (select *, n * 0.9::double as q0, n * 0.05::double as q1 from r),
e as (select *, floor(q0) as f0, floor(q1) as f1, q0 - floor(q0) as e0, q1 - floor(q1) as e1 from q),
b as (select *, f0 + case when (e1 > e0)::int * 2 < n - f0 - 2 * f1 then 1 else 0 end as c0, f1 + case when (e0 >= e1)::int < n - f0 - 2 * f1 then 1 else 0 end as c1 from e),
s as (select {by}, {name}, case when rn <= c0 then 'train' when rn <= c0 + c1 then 'validation' else 'test' end as split from b)"""


_DOC_KEY = "'42' || chr(31) || source || chr(31) || document"
_SPLIT = f"with d as (select distinct source, cast(doc_id as varchar) as document from documents), {_shares('d', 'source', _DOC_KEY, 'document')}"


# --- text -------------------------------------------------------------------------------------


@query(f"select doc_id, {_TOKENS('text')} as estimated_tokens, cast(floor(length(text) / 4.0::double) as bigint) as floor_tokens from documents")
def token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _read(spark, sf_dir, "documents")
    return d.select("doc_id", T.estimate_tokens(F.col("text")).alias("estimated_tokens"), T.floor_tokens(F.col("text")).alias("floor_tokens"))


@query("select doc_id, substr(sha256(source || chr(31) || doc_id::varchar), 1, 24) as id from documents")
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", T.stable_id(F.col("source"), F.col("doc_id")).alias("id"))


@query(f"select doc_id, sha256(t) as text_sha256, length(t)::bigint as n from (select doc_id, {_NORMAL} as t from ({_MORE}))")
def normalize_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = with_literals(spark, sf_dir).select(F.col("ord").alias("doc_id"), T.normalize_text(F.col("text")).alias("t"))
    return d.select("doc_id", F.sha2("t", 256).alias("text_sha256"), F.length("t").cast("long").alias("n"))


@query(f"select doc_id, sha256({_FOLD('text')}) as fingerprint from documents")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("doc_id", T.exact_fingerprint(F.col("text")).alias("fingerprint"))


# --- quality and deduplication ------------------------------------------------------------------


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.quality_checked(documents(spark, sf_dir))


@query(f"{_JUDGED(_MORE)} select doc_id, coalesce(reason, 'accepted') as reason from c")
def quality_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.quality_checked(with_literals(spark, sf_dir)).select(F.col("ord").alias("doc_id"), F.coalesce("reason", F.lit("accepted")).alias("reason"))


@query(f"{_CHECKED} select source, coalesce(reason, 'accepted') as reason, count(*) as records from c group by all")
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).groupBy("source", F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count(F.lit(1)).alias("records"))


@query(
    r"select conv_id, turn, coalesce(case when length(text) < 200 then 'too_short' end, 'long_enough') as reason, "
    r"len(list_filter(string_split_regex(text, '\s+'), lambda k: k <> ''))::bigint as words from conversations"
)
def turn_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "conversations")
    short = F.when(rejection_reason(F.col("text"), F.lit("CC")) == "too_short", "too_short").otherwise("long_enough")
    return c.select("conv_id", "turn", short.alias("reason"), F.size(F.filter(F.split("text", r"\s+"), lambda k: k != "")).cast("long").alias("words"))


def _narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("doc_id", "source", T.exact_fingerprint(F.col("text")).alias("fp"))


@query(f"select doc_id, fp as fingerprint from (select doc_id, sha256({_FOLD('text')}) as fp from documents) qualify row_number() over (partition by fp order by doc_id) = 1")
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.keep_first(_narrow(spark, sf_dir), "fp", "doc_id").select("doc_id", F.col("fp").alias("fingerprint"))


@query(f"select doc_id, nullif(first_value(doc_id) over (partition by sha256({_FOLD('text')}) order by doc_id), doc_id) as duplicate_of from documents")
def duplicate_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a fingerprint is computed once; what is read twice is a table of two numbers and a hash
    narrow = keep(_narrow(spark, sf_dir).select("doc_id", F.col("doc_id").alias("ord"), "fp"), "fingerprints")
    return cleaning.mark_duplicates(narrow, "fp", "ord", ["doc_id"]).select("doc_id", F.col("duplicate_of.doc_id").alias("duplicate_of"))


@query("select conv_id, sha256(string_agg(text, chr(10) || chr(10) order by turn)) as text_sha256, count(*) as sections from conversations group by conv_id")
def doc_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = cleaning.assemble_documents(_read(spark, sf_dir, "conversations"), ["conv_id"], "text", "turn")
    return whole.select("conv_id", F.sha2("document_text", 256).alias("text_sha256"), "sections")


@query(
    "with m as (select user_id, event_type, (event_type is distinct from lag(event_type) over (partition by user_id order by event_id))::int as fresh from events) "
    "select user_id, event_type, sum(fresh)::bigint as runs from m group by all having sum(fresh) > 1"
)
def contiguity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as documents and users as files: which ones come back after others."""
    e = _read(spark, sf_dir, "events").select("user_id", "event_type", F.col("event_id").alias("ord"))
    return cleaning.contiguity_violations(e, ["event_type"], ["user_id"]).select("user_id", "event_type", F.col("runs").cast("long").alias("runs"))


def _judged_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source, document, ord, reason, tokens, fp of every record: texts are cleaned once, and all that follows reads this table."""
    text = F.col("text")
    return keep(_checked(spark, sf_dir).select("source", "document", "ord", "reason", T.estimate_tokens(text).alias("tokens"), F.when(F.col("reason").isNull(), T.exact_fingerprint(text)).alias("fp")), "judged")


@query(
    f"{_ACCEPTED} select source, count(*) as input_documents, count(*) filter (k = 1) as accepted_records, coalesce(sum({_TOKENS('t')}) filter (k = 1), 0)::bigint as estimated_tokens, "
    "count(*) filter (k > 1) as duplicate_documents from (select c.source, c.t, a.k from c left join a using (doc_id)) group by source"
)
def source_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = _judged_narrow(spark, sf_dir)
    first = checked.where("reason is null").groupBy("fp").agg(F.min("ord").alias("first"))
    # rejected records, which have no fingerprint, go past the join
    judged = checked.where("reason is null").join(first, "fp").select("source", "ord", "tokens", "first").unionByName(checked.where("reason is not null").select("source", "ord", "tokens", F.lit(None).cast("long").alias("first")))
    kept = F.col("first") == F.col("ord")
    return judged.groupBy("source").agg(
        F.count(F.lit(1)).alias("input_documents"),
        F.count(F.when(kept, 1)).alias("accepted_records"),
        F.coalesce(F.sum(F.when(kept, F.col("tokens"))), F.lit(0)).cast("long").alias("estimated_tokens"),
        F.count(F.when(~kept, 1)).alias("duplicate_documents"),
    )


# --- splits -----------------------------------------------------------------------------------


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("source", F.col("doc_id").cast("string").alias("document"))


@query(f"{_SPLIT} select * from s")
def split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.assign_by_source(_named(spark, sf_dir), SEED)


@query(f"{_SPLIT} select s.source, split, count(*) as records, count(distinct s.document) as documents, sum({_TOKENS('text')})::bigint as tokens from s join documents d on s.source = d.source and s.document = d.doc_id::varchar group by all")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir).withColumn("estimated_tokens", T.estimate_tokens(F.col("text"))).select("source", "document", "estimated_tokens")
    return stats.split_counts(splits.split_records(d, splits.assign_by_source(d, SEED)))


@query(f"{_SPLIT} select source, document, count(distinct split) as splits from s group by all having count(distinct split) > 1")
def leakage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.leakage(splits.assign_by_source(_named(spark, sf_dir), SEED))


@query(f"{_SPLIT} select d.doc_id, coalesce(h.split, 'train') as split from documents d left join (select * from s where split <> 'train') h on h.source = d.source and h.document = d.doc_id::varchar")
def split_join_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _read(spark, sf_dir, "documents").select("doc_id", "source", F.col("doc_id").cast("string").alias("document"))
    return splits.split_records(d, splits.assign_by_source(d, SEED)).select("doc_id", "split")


@query(
    "with r as (select conv_id::varchar as id from conversations group by 1), k as (select id, row_number() over (order by sha256('42:' || id)) as rn, count(*) over () as n from r), "
    "e as (select *, case when n >= 20 then greatest(1, round_even(n * 0.05::double, 0)) else round_even(n * 0.05::double, 0) end as each_ from k) "
    "select id, case when rn <= n - 2 * each_ then 'train' when rn <= n - each_ then 'validation' else 'test' end as split from e"
)
def conv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("id")).distinct()
    return splits.assign_by_share(ids, "id", SEED)


@query(
    "with g as (select distinct event_type as grp from events), k as (select grp, row_number() over (order by sha256('42:' || grp)) as rn, count(*) over () as n from g), "
    "e as (select *, greatest(1, round_even(n * 0.05::double, 0)) as each_ from k), s as (select grp, case when rn <= n - 2 * each_ then 'train' when rn <= n - each_ then 'validation' else 'test' end as split from e) "
    "select event_type, split, count(*) as rows from events join s on grp = event_type group by all"
)
def group_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events").select("event_type")
    s = splits.assign_groups(e, "event_type", SEED)
    # counts before the join: a group may hold a third of all rows
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows")).join(s, F.col("event_type") == F.col("group")).select("event_type", "split", "rows")


@query("select doc_id from documents order by sha256('42:' || doc_id::varchar), doc_id limit 100")
def subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.take_subset(_read(spark, sf_dir, "documents").select("doc_id"), 100, "doc_id", SEED)


@query(
    f"{_SPLIT}, u as (select document as id, source, split from s) select id, source, split, sha256('42:' || split || ':' || id) as shuffle_key, "
    "row_number() over (partition by split order by sha256('42:' || split || ':' || id))::bigint as place from u"
)
def merged_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = splits.assign_by_source(_named(spark, sf_dir), SEED).select(F.col("document").alias("id"), "source", "split")
    early = F.coalesce(F.col("source") < "src5", F.lit(True))
    merged = splits.merged(s.where(early), s.where(~early), seed=SEED)
    return splits.ranked(merged, ["split"], F.col("shuffle_key")).select("id", "source", "split", "shuffle_key", F.col("rn").cast("long").alias("place"))


# --- sums and percentiles ---------------------------------------------------------------------


_LENGTHS = "count(*) as rows, quantile_disc(v, 0.5) as p50, quantile_disc(v, 0.9) as p90, quantile_disc(v, 0.95) as p95, quantile_disc(v, 0.99) as p99, max(v) as max"


@query(f"select source, {_LENGTHS} from (select source, {_TOKENS('text')} as v from documents) group by source")
def length_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.length_summary(_read(spark, sf_dir, "documents"), "source", T.estimate_tokens(F.col("text")))


@query(f"select role, {_LENGTHS} from (select role, length(text)::bigint as v from conversations) group by role")
def turn_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.length_summary(_read(spark, sf_dir, "conversations"), "role", F.length("text"))


@query(f"select sum({_TOKENS('text')})::bigint as tokens, ceil(sum({_TOKENS('text')}) / (4096.0::double * 128))::bigint as steps from documents")
def steps_per_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _read(spark, sf_dir, "documents").select(T.estimate_tokens(F.col("text")).alias("estimated_tokens"))
    return stats.token_sum(d).select("tokens", T.steps_per_epoch(F.col("tokens"), 4096, 4, 16, 2).alias("steps"))


@query("select event_id, round(case when value / 20 < 100 then exp(value / 20) when value is not null then 'inf'::double end, 6) as perplexity, value >= 2000 as infinite from events")
def perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a loss of value / 20."""
    e = _read(spark, sf_dir, "events").select("event_id", "value")
    return e.select("event_id", T.rounded_perplexity(F.col("value") / 20, 6).alias("perplexity"), (F.col("value") >= 2000).alias("infinite"))


@query("select d.doc_id from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id and l.toxic = 1)")
def exclusion_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _read(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    return _read(spark, sf_dir, "documents").select("doc_id").join(out, "doc_id", "left_anti")


# --- sections ---------------------------------------------------------------------------------


def _assembled(spark: SparkSession, sf_dir: str, head: str) -> DataFrame:
    """Each conversation as one text with a heading for each turn. head: SQL for the heading lines."""
    c = _read(spark, sf_dir, "conversations").withColumn("part", F.expr(f"concat({head}, '\\n', text)"))
    return cleaning.assemble_documents(c, ["conv_id"], "part", "turn", "\n").select("conv_id", F.col("document_text").alias("text"))


_SECTIONS = "select conv_id, (row_number() over (partition by conv_id order by turn) - 1)::integer as section_no, role || ' ' || turn as section_title, sha256({body}) as body_sha256 from conversations"


def _digest(cut: DataFrame) -> DataFrame:
    return cut.select("conv_id", "section_no", "section_title", F.sha2("body", 256).alias("body_sha256"))


@query(_SECTIONS.format(body=_STRIP("'## ' || role || ' ' || turn || chr(10) || text")))
def sections_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(sections.markdown_sections(_assembled(spark, sf_dir, "'## ', role, ' ', turn"), "text", F.lit("untitled")))


@query(_SECTIONS.format(body=_STRIP("role || ' ' || turn || chr(10) || '=======' || chr(10) || text")))
def sections_rst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(sections.rst_sections(_assembled(spark, sf_dir, "role, ' ', turn, '\\n======='"), "text", F.lit("untitled")))


@query(
    _SECTIONS.format(body=_STRIP("case when row_number() over (partition by conv_id order by turn) = 1 then '# book' || chr(10) else '' end || '## ' || role || ' ' || turn || chr(10) || text")).replace(
        "role || ' ' || turn as section_title", "case when count(*) over (partition by conv_id) = 1 then 'book' else role || ' ' || turn end as section_title"
    )
)
def chapters_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A book with one chapter only is cut at its own heading, not at the chapter's."""
    books = _assembled(spark, sf_dir, "'## ', role, ' ', turn").withColumn("text", F.concat(F.lit("# book\n"), "text"))
    return _digest(sections.markdown_chapters(books, "text", F.lit("untitled")))


# --- chats ------------------------------------------------------------------------------------


_SPOKEN = (
    "select conv_id, turn, role, trim(text, ' ' || chr(9) || chr(10) || chr(13)) as text, row_number() over (partition by conv_id order by turn) as k, count(*) over (partition by conv_id) as n "
    "from conversations where role in ('user', 'assistant')"
)
_GOOD = f"with sp as ({_SPOKEN}), g as (select conv_id from sp group by conv_id, n having n % 2 = 0 and bool_and(text <> '' and role = case when k % 2 = 1 then 'user' else 'assistant' end))"
_JSON = "'[' || string_agg('{\"content\": ' || to_json(text)::varchar || ', \"role\": \"' || role || '\"}', ', ' order by k) || ']'"
_FULL = f"{_GOOD}, j as (select conv_id, {_JSON} as js from sp where conv_id in (select conv_id from g) group by conv_id), l as (select *, sha256(js) as fp from j where length(js) <= 32000), u as (select *, row_number() over (partition by fp order by conv_id) as r from l)"


@query(f"{_GOOD} select c.conv_id, (g.conv_id is not null) as valid from (select distinct conv_id from conversations) c left join g on g.conv_id = c.conv_id")
def role_alternation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats(spark, sf_dir).select(F.col("ord").alias("conv_id"), chat.clean_messages(F.col("messages")).isNotNull().alias("valid"))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.check_chats(chats(spark, sf_dir), _read(spark, sf_dir, "benchmark").select("item_id"))


@query(
    f"{_FULL} select c.conv_id, case when b.item_id is not null then 'reserved_for_cpt' when g.conv_id is null then 'empty_or_bad_role_sequence' when l.conv_id is null then 'overly_long' "
    "when row_number() over (partition by (b.item_id is null and l.conv_id is not null), l.fp order by c.conv_id) > 1 then 'exact_duplicate' else 'accepted' end as reason "
    "from (select distinct conv_id from conversations) c left join benchmark b on b.item_id = c.conv_id left join g on g.conv_id = c.conv_id left join l on l.conv_id = c.conv_id"
)
def chat_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select(F.col("ord").alias("conv_id"), F.coalesce("reason", F.lit("accepted")).alias("reason"))


@query(f"{_FULL} select conv_id, fp as fingerprint from u where r = 1")
def conv_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.dedup_chats(chat.check_chats(chats(spark, sf_dir))).select(F.col("ord").alias("conv_id"), "fingerprint")


@query(f"{_FULL} select 'general_' || substr(sha256(conv_id::varchar), 1, 24) as id, conv_id::varchar as identifier, fp as fingerprint, sha256('42:' || conv_id::varchar) as hash from u where r = 1 order by hash, conv_id limit 30")
def conv_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.sample_chats(chat.check_chats(chats(spark, sf_dir)), chat.ChatRules(sample=30)).drop("messages")


@query("select (case when conv_id % 3 = 0 then 'train' when conv_id % 3 = 1 then 'test' else 'train' end) as split, count(distinct conv_id) as chats from conversations group by 1")
def upstream_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.when(F.col("conv_id") % 3 == 1, "test").when(F.col("conv_id") % 3 == 0, "train").otherwise("holdout")
    return _read(spark, sf_dir, "conversations").groupBy(splits.keep_upstream(given).alias("split")).agg(F.countDistinct("conv_id").alias("chats"))


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as canonical rows, good or not."""
    turns = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    row = F.struct(F.concat(F.lit("c"), "prompt_id").alias("id"), F.lit("chat").alias("source"), F.lit("general").alias("task_type"), F.lit("").alias("system"), F.array().cast("array<string>").alias("tools"), turns.alias("turns"), F.struct(F.lit("x").alias("k")).alias("metadata"))
    return chats(spark, sf_dir).select(F.to_json(row).alias("row"), "ord", F.lit("chat").alias("source"))


@query(
    "with t as (select *, row_number() over (partition by conv_id order by turn) - 1 as k, row_number() over (partition by conv_id order by turn desc) as back from conversations), e as ("
    "select conv_id, 1 as p, 0 as k, 'first turn must be user' as m from t where k = 0 and role <> 'user' union all "
    "select conv_id, 2, k, 'turns[' || k || '] has invalid role ''' || role || '''' from t where role not in ('user', 'assistant', 'tool') union all "
    "select conv_id, 2, k, 'turns[' || k || '] has empty user content' from t where role = 'user' and trim(text) = '' union all "
    "select conv_id, 2, k, 'turns[' || k || '] assistant is empty' from t where role = 'assistant' and trim(text) = '' union all "
    "select conv_id, 3, 0, 'at least one non-empty assistant response is required' from t group by conv_id having count(*) filter (role = 'assistant' and trim(text) <> '') = 0 union all "
    "select conv_id, 4, 0, 'conversation must end with assistant' from t where back = 1 and role <> 'assistant') "
    "select c.conv_id, coalesce(string_agg(m, '; ' order by p, k), '') as errors from (select distinct conv_id from conversations) c left join e on e.conv_id = c.conv_id group by c.conv_id"
)
def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.validate(_rows(spark, sf_dir)).select(F.col("ord").alias("conv_id"), F.array_join("errors", "; ").alias("errors"))


@query("select conv_id, sha256('[' || string_agg('{\"content\": ' || to_json(text)::varchar || ', \"role\": \"' || role || '\"}', ', ' order by turn) || ']') as messages_sha256 from conversations group by conv_id")
def rendered_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _rows(spark, sf_dir).withColumn("r", canonical.rendered(F.col("row")))
    return r.select(F.col("ord").alias("conv_id"), F.sha2("r.messages", 256).alias("messages_sha256"))


# --- values and traces ------------------------------------------------------------------------


@query("select event_type as tool, 'k' as key, 'number' as type, true as required from events group by event_type")
def tool_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agent.tool_schemas(_read(spark, sf_dir, "events"), "event_type", "props", "event_id")


@query("select event_id, 'object' as props_type, 'number' as k_type, '{\"k\":' || (props::json->>'k') || '}' as metadata, '{\"raw\":\"' || event_type || '\"}' as raw from events")
def json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    return e.select("event_id", json_type(F.col("props")).alias("props_type"), json_type(F.get_json_object("props", "$.k")).alias("k_type"), metadata_object(F.col("props")).alias("metadata"), metadata_object(F.col("event_type")).alias("raw"))


@query()
def agent_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation as an incident: its user turns are calls, its assistant turns their results and the end."""
    log = lambda **kv: F.to_json(F.struct(*[v.alias(k) for k, v in kv.items()]))
    events = F.flatten(
        F.transform(
            "messages",
            lambda m: F.when(
                m["role"] == "user",
                F.array(log(event=F.lit("tool_start"), tool=F.struct(F.lit("look").alias("name"), F.lit("looks").alias("description")), input=F.to_json(F.struct(m["content"].alias("q"))))),
            ).otherwise(F.array(log(event=F.lit("tool_end"), output=m["content"]))),
        )
    )
    last = log(event=F.lit("llm_end"), text=F.lit("done"), generation_info=F.struct(F.lit("stop").alias("finish_reason")))
    truth = F.lit('{"is_anomaly": true, "faulty_devices": ["r1"], "root_cause_name": []}')
    incident = chats(spark, sf_dir).select(
        F.concat(F.lit("made/kind"), F.pmod(F.col("ord"), F.lit(5)).cast("string"), F.lit("/"), "prompt_id").alias("dir"),
        truth.alias("truth"), truth.alias("submission"), F.lit('{"task_description": "find it"}').alias("session"), F.array_join(F.concat(events, F.array(last)), "\n").alias("log"),
    )
    done = agent.convert_incidents(incident, "You find faults.")
    return done.select("dir", "failure_type", "reason", F.size(canonical.row_errors(F.coalesce("row", F.lit("{}")))).alias("errors"), F.sha2("row", 256).alias("row_sha256"))


# --- the whole corpus ---------------------------------------------------------------------------


@query(
    f"{_ACCEPTED}, d as (select distinct source, doc_id::varchar as document from a where k = 1), {_shares('d', 'source', _DOC_KEY, 'document')} "
    f"select s.source, split, count(*) as documents, sum({_TOKENS('t')})::bigint as tokens from s join a on a.source = s.source and a.doc_id::varchar = s.document and a.k = 1 group by all"
)
def corpus_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the cleaned, deduplicated corpus holds for each source and split."""
    narrow = _judged_narrow(spark, sf_dir).where("reason is null").withColumnRenamed("tokens", "estimated_tokens")
    kept = cleaning.keep_first(narrow, "fp", "ord")
    placed = splits.split_records(kept, splits.assign_by_source(kept, SEED))
    return placed.groupBy("source", "split").agg(F.count(F.lit(1)).alias("documents"), F.sum("estimated_tokens").cast("long").alias("tokens"))
