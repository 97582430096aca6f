"""Personal data: patterns of known kinds, and bootstrapped extraction from contexts.

What the patterns of the four base kinds find are the seeds. The words around each seed induce lexical
patterns (two words before it; a word before and one after). The same patterns are noted around every other
token with a digit or an at sign, and around neighbouring groups of digits and signs as one unit. Patterns and instances form a graph with one edge for
each pair that occurs, however often, so copies count once. Spark scores it in rounds: a pattern by
the share of its instances that are trusted, an instance by the patterns it stands in; instances
that reach ``least_instance`` are trusted in the next round. At the end, tokens that are no seeds and stand in a trusted
pattern are reported as ``context`` spans.

A missing or empty text has no spans. Repeated rows and null doc_ids keep a row each; an empty table gives none. A text is
searched whole, however long, and its notes leave the task a pattern at a time. Columns besides doc_id and text are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from harborlake.llm.common import slices, stored, texts

KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"
ROUNDS = 3
LEAST_SUPPORT = 2.0
LEAST_PATTERN = 0.6
LEAST_INSTANCE = 0.6
LEAST_CHARS = 5

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"\S+")
_MARKED = re.compile(r"[0-9@]")
_GROUP = re.compile(r"[(+]*[0-9][0-9().+-]*")
_EDGE = "\"'`.,;:!?()[]{}<>|*"


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        v = int(d) * (2 if n % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each domain is looked for from its at sign, then the name before it, so long words cost no more than their length."""
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            yield start, end


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start, in code points."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def _plain(word: str) -> str:
    return re.sub("[0-9]", "0", word.strip(_EDGE).lower())


def joined_groups(text: str, units: list[tuple[int, int, str | None]]) -> Iterator[tuple[int, int, int, int]]:
    """First and last unit, start and end of each row of two or more groups of digits and signs that only blanks part."""
    n = 0
    while n < len(units):
        first = last = None
        while n < len(units) and units[n][2] is None:
            a, b, _ = units[n]
            shown = text[a:b].rstrip(".,;:!?")
            apart = first is not None and text[units[n - 1][1] : a].strip(" \t")
            if apart or not _GROUP.fullmatch(shown):
                break
            first, last, end = n if first is None else first, n, a + len(shown)
            n += 1
            if end < b:  # a sign of punctuation ends the row
                break
        if first is None:
            n += 1
        elif last > first:
            start = units[first][0]
            if text[start] == "(" and text.find(")", start, end) in (-1, end - 1):  # around the whole row
                start, end = start + 1, end - (text[end - 1] == ")")
            yield first, last, start, end


def mentions(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """Seeds and other marked tokens with the patterns around them."""
    if not _MARKED.search(text):
        return []
    covered, units, at = sorted((a, b, k) for k, a, b in spans), [], 0
    for a, b, kind in covered:  # a span that lies in another is part of that unit
        if a < at:
            continue
        units += [(m.start(), m.end(), None) for m in _TOKEN.finditer(text, at, a)]
        units.append((a, b, kind))
        at = b
    units += [(m.start(), m.end(), None) for m in _TOKEN.finditer(text, at)]
    out = []

    def note(first: int, last: int, a: int, b: int, seed: bool) -> None:
        before = [_plain(text[u[0] : u[1]]) for u in units[max(0, first - 2) : first]]
        after = _plain(text[units[last + 1][0] : units[last + 1][1]]) if last + 1 < len(units) else ""
        patterns = []
        if len(before) == 2 and all(before):
            patterns.append(f"{before[0]} {before[1]} <>")
        if before and before[-1] and after:
            patterns.append(f"{before[-1]} <> {after}")
        if patterns:
            out.append({"start": a, "end": b, "instance": text[a:b].lower(), "seed": seed, "patterns": patterns})

    for n, (a, b, kind) in enumerate(units):
        value = text[a:b]
        if kind is None:
            if not _MARKED.search(value):
                continue
            cut = len(value) - len(value.lstrip(_EDGE))
            value = value.strip(_EDGE)
            a, b = a + cut, a + cut + len(value)
            if len(value) < LEAST_CHARS:
                continue
        note(n, n, a, b, kind is not None)
    for first, last, a, b in joined_groups(text, units):
        if b - a >= LEAST_CHARS:
            note(first, last, a, b, False)
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_MENTION = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("instance", pa.string()), ("seed", pa.bool_()), ("patterns", pa.list_(pa.string()))])


def scanned(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base (spans), mentions."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bases, noted = [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                bases.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                noted.append(mentions(text, spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(bases, pa.list_(_SPAN)), pa.array(noted, pa.list_(_MENTION))],
                ["doc_id", "base", "mentions"],
            )

    rows = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(
        found,
        """doc_id long, base array<struct<kind:string,start:int,end:int>>,
        mentions array<struct<start:int,end:int,instance:string,seed:boolean,patterns:array<string>>>""",
    )


def trusted(edges: DataFrame, seeds: DataFrame, *, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(patterns with confidence, instances with score) after ``rounds`` over the graph of ``edges`` (pattern, instance)."""
    degree = stored(edges.groupBy("pattern").agg(F.count("*").alias("degree")).where("degree > 1"), "degrees")
    edges = stored(edges.join(degree, "pattern", "left_semi"), "edges")
    first = seeds.select("instance", F.lit(1.0).alias("score"))
    known = first
    for _ in range(rounds):
        weight = edges.join(known, "instance").groupBy("pattern").agg(F.sum("score").alias("weight"))
        patterns = stored(
            weight.where(F.col("weight") >= LEAST_SUPPORT)
            .join(degree, "pattern")
            .select("pattern", (F.col("weight") / (F.col("degree") + 1)).alias("confidence"))
            .where(F.col("confidence") >= LEAST_PATTERN),
            "patterns",
        )
        score = 1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))
        inferred = edges.join(patterns, "pattern").groupBy("instance").agg(score.alias("score"))
        inferred = inferred.where(F.col("score") >= LEAST_INSTANCE).join(first, "instance", "left_anti")
        known = stored(first.union(inferred), "instances")
    return patterns, known


def personal_data(docs: DataFrame, *, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, base and all (arrays of kind, start, end)."""
    rows = stored(scanned(docs).withColumn("row", F.monotonically_increasing_id()), "mentions")
    noted = rows.select("row", F.inline("mentions"))
    edges = noted.select("instance", F.explode("patterns").alias("pattern")).distinct()
    seeds = stored(noted.where("seed").select("instance").distinct(), "seeds")
    patterns, instances = trusted(edges, seeds, rounds=rounds)
    new = (
        noted.where("not seed")
        .select("row", "start", "end", "instance", F.explode("patterns").alias("pattern"))
        .join(patterns.select("pattern"), "pattern", "left_semi")
        .join(instances.select("instance"), "instance", "left_semi")
        .groupBy("row")
        .agg(F.collect_set(F.struct(F.lit(CONTEXT).alias("kind"), "start", "end")).alias("new"))
    )
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return rows.drop("mentions").join(new, "row", "left").select(
        "doc_id", "base", F.concat("base", F.coalesce("new", none)).alias("all")
    )


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context of ``personal_data``."""
    order = F.array(*[F.lit(k) for k in (*KINDS, CONTEXT)])

    def joined(spans: str) -> Column:
        keyed = F.transform(spans, lambda s: F.struct(F.array_position(order, s.kind), s.start, s.end, s.kind.alias("kind")))
        shown = F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s.kind, s["start"].cast("string"), s["end"].cast("string")))
        return F.concat_ws(",", shown)

    def number(kind: str) -> Column:
        return F.size(F.filter("all", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(k) for k in KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("all").alias("spans"),
        number(CONTEXT),
    )
