"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content.  A
ledger row says that a blob was scanned with a rule version and what was found;
a run scans only the (blob, rule version) pairs that the ledger lacks, and the
findings are joined back to all paths that have the blob.

All work is done by SQL functions.  Positions come from ``regexp_replace``: a
match is set between control characters, and the lengths of the pieces between
them, summed up, are the offsets (in code points).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_name


@dataclass(frozen=True)
class Rule:
    """``prefix`` and ``value`` are patterns without capturing groups; a match whose value is shorter than ``least`` is dropped."""

    kind: str
    version: int
    prefix: str
    value: str
    least: int


# The base kinds, in the order that breaks ties of their spans.
BASE = (
    Rule("assign", 1, r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+", 6),
    Rule("access", 1, "", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", 1, "", r"[0-9a-f]+", 24),
)
# A private key: from its BEGIN line through its END line; without an END line the header, the key's own fields and the
# base64 lines that follow, the last of which may be short.  Line breaks may be written out (\n) or lost.
_PEM_GAP = r"(?:\s|\\[nr]|>)*+"
_PEM = (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
        r"(?:(?:[^-]++|-(?!----))*+-----END [A-Z ]{0,40}PRIVATE KEY-----"
        rf"|(?:{_PEM_GAP}(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+(?:(?:{_PEM_GAP}[A-Za-z0-9+/]{{16,}}+={{0,2}})++"
        r"(?:(?:[\r\n]|\\[nr])(?:\s|>)*+[A-Za-z0-9+/]++={0,2}(?=[\t\x20]*+(?:[\r\n\\\"']|\z)))?+)?+)")
# Kinds added to the base.
ADDED = (
    Rule("pem", 2, "", _PEM, 1),
    Rule("forge", 1, "", r"gh[pousr]_[A-Za-z0-9]{36,}", 1),
)
RULES = BASE + ADDED
# Runs whose length is all that is asked of them are matched with that length at
# once: a run that is too short holds no other match, so nothing changes.
_SHORTCUT = {("access", 1): r"AKIA[A-Z0-9]{16,}", ("hex", 1): r"[0-9a-f]{24,}"}
_OPEN, _MID, _CLOSE, _OTHER = "\x01", "\x02", "\x03", "\x04"
LEDGER = "blob string, kind string, version int, spans array<struct<start:int,end:int>>"


def content(text: Column) -> Column:
    """Address of a content; a null text is the empty content."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _spans(text: Column, rule: Rule) -> Column:
    """``array<struct<start,end>>`` of a rule's matches in ``text``, leftmost and non-overlapping."""
    pattern = f"({rule.prefix})({_SHORTCUT.get((rule.kind, rule.version), rule.value)})"
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(done: Column, part: Column) -> Column:
        mid, close = F.instr(part, _MID), F.instr(part, _CLOSE)
        begin = done["at"]
        end = begin + close - 2                                   # without the two marks before the close
        found = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct((end + F.length(part) - close).alias("at"),
                        F.when(close - mid - 1 >= rule.least, F.concat(done["out"], found)).otherwise(done["out"]).alias("out"))

    def offsets(parts: Column) -> Column:
        return F.aggregate(F.slice(parts, 2, F.size(parts)), F.struct(F.length(parts[0]).alias("at"), none.alias("out")),
                           step, lambda done: done["out"])

    def found_in(marked: Column) -> Column:
        return F.when(F.instr(marked, _OPEN) > 0, _bound(F.split(marked, _OPEN), offsets)).otherwise(none)
    return _bound(F.regexp_replace(text, pattern, f"{_OPEN}$1{_MID}$2{_CLOSE}"), found_in)


def scan(blobs: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """New ledger rows for the pairs of ``blobs`` (blob, text; blob unique) and ``rules`` that ``ledger`` lacks.

    A pair without findings gets a row with an empty list, so it is not scanned again.
    """
    pending, done = blobs, F.array().cast("array<string>")
    if ledger is not None:
        seen = ledger.groupBy(F.col("blob").alias("_seen")).agg(F.collect_set(F.concat_ws(":", "kind", "version")).alias("_done"))
        pending = blobs.join(seen, F.col("blob") == F.col("_seen"), "left")
        done = F.coalesce(F.col("_done"), done)
    clean = F.translate("text", _OPEN + _MID + _CLOSE, _OTHER * 3)      # keeps every offset

    def pairs(text: Column) -> Column:
        return F.array(*[F.when(~F.array_contains(done, f"{r.kind}:{r.version}"),
                                F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), _spans(text, r).alias("spans")))
                         for r in rules])
    rows = pending.select("blob", F.explode(F.filter(_bound(clean, pairs), lambda p: p.isNotNull())).alias("p"))
    return rows.select("blob", "p.kind", "p.version", "p.spans")


def blobs_of(versions: DataFrame, text_col: str = "text") -> DataFrame:
    """``blob, text``: every distinct content once (copies are combined before the shuffle)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return versions.select(content(F.col(text_col)).alias("blob"), text.alias("text")).dropDuplicates(["blob"])


def findings(ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``blob, spans``: all findings of the given rule versions, by start, then kind in the rules' order."""
    order = F.lit(None).cast("int")
    for i, r in enumerate(rules):
        order = F.when((F.col("kind") == r.kind) & (F.col("version") == r.version), F.lit(i)).otherwise(order)
    hits = ledger.withColumn("ord", order).where("ord is not null and size(spans) > 0")
    each = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("ord").alias("ord"), s["end"].alias("end"),
                                                   F.col("kind").alias("kind")))
    return hits.select("blob", each.alias("s")).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("s"))).alias("spans"))


def scan_paths(versions: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES,
               path_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(findings per path, new ledger rows)`` for a table of versions (one row per path and version).

    ``(path_col, blob, spans)`` has one row per version; ``spans`` is empty
    where nothing was found.  Null texts are empty contents; repeated rows and
    null paths stay as they are; an empty table gives two empty tables.
    """
    new = scan(blobs_of(versions, text_col), ledger, rules)
    all_rows = new if ledger is None else new.unionByName(ledger.select("blob", "kind", "version", "spans"))
    paths = versions.select(path_col, content(F.col(text_col)).alias("blob"))
    joined = paths.join(findings(all_rows, rules), "blob", "left")
    empty = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string>>")
    return joined.select(path_col, "blob", F.coalesce("spans", empty).alias("spans")), new


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row."""
    found, _ = scan_paths(docs, path_col=id_col, text_col=text_col)
    spans = F.col("spans")

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = written(F.filter(spans, lambda s: s["kind"].isin(*(r.kind for r in BASE))))
    return found.select(F.col(id_col).cast("long").alias("doc_id"), *(number(r.kind) for r in BASE),
                        F.sha2(base.cast("binary"), 256).alias("base_sha256"), written(spans).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark`` (overlapping spans by one); all columns and rows stay.

    ``n_chars``, where there is such a column, follows the new text.
    """
    new = scan(blobs_of(docs, text_col))
    blob, found = free_name(docs, "_blob"), free_name(docs, "_spans")
    hits = findings(new).select(F.col("blob").alias(blob), F.col("spans").alias(found))
    text = F.col(text_col)

    def step(done: Column, s: Column) -> Column:
        gap = F.when(s["start"] >= done["at"], F.concat(done["out"], F.substring(text, done["at"] + 1, s["start"] - done["at"]), F.lit(mark)))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), gap.otherwise(done["out"]).alias("out"))
    clean = F.aggregate(found, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                        lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))
    joined = docs.withColumn(blob, content(text)).join(hits, blob, "left")
    joined = joined.withColumn(text_col, F.when(F.col(found).isNotNull(), clean).otherwise(text))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(F.col(found).isNotNull(), F.length(text_col).cast(docs.schema["n_chars"].dataType))
                                   .otherwise(F.col("n_chars")))
    return joined.select(*docs.columns)
