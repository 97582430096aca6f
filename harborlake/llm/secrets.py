"""Secret scans: patterns, and a battery of randomness tests with false-discovery control, in SQL functions only.

Tokens of at least 16 letters, digits and signs of encoded values are tested. For each, the encoding is
inferred from its characters and gives an alphabet; then three tests ask whether the token could be
drawn uniformly from it: chi-squared of the symbol counts, the number of runs above and below the middle of the
alphabet, and the correlation of neighbouring symbols. Their p values are combined by Fisher's method.

A token whose p value is below LEAST_P is not random. Of the others, those are reported that ordinary text does not
explain: how much likelier a token is drawn uniformly from its alphabet than written by a fixed model of ordinary text
(letters as frequent as in European languages, kinds of characters that seldom change) is an e value, and for each
encoding and band of lengths the e values are cut where the false-discovery rate is at most ``rate`` (the procedure of
Benjamini and Hochberg for e values). The model does not depend on the table, so neither words nor other keys are
needed as controls, and tokens of letters in one case are tested like all others, against their 26 letters. Tokens of digits
alone are not tested: they are numbers.

A missing or empty text has no spans. Repeated rows and null doc_ids keep a row each; an empty table gives none. Columns besides
doc_id and text are never read. A text of any length costs in proportion to its tokens.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from harborlake.llm.common import stored, texts

# The kinds in order, and the pattern of each.
KINDS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
LEAST_ASSIGNED = 6
RANDOM = "random"
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
RATE = 0.05
LEAST_P = 0.01
MOST_BITS = 63  # of an e value
TOGETHER = 256  # matches whose places are added up in one go

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SIGNS = "+/_=-"
# Encodings in the order they are tried: pattern of the token, alphabet. A capital before small letters counts as one of them.
_TITLE = r"^[A-Z]?[a-z]+$"
ENCODINGS = (
    (_TITLE, _LOWER),
    (r"^[A-Z]+$", _UPPER),
    (r"^[0-9a-f]+$", _DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    (r"^[A-Z2-7]+=*$", _UPPER + "234567"),
    (r"^[A-Z0-9]+$", _DIGITS + _UPPER),
    (r"^[a-z0-9]+$", _DIGITS + _LOWER),
    (r"^[A-Za-z0-9]+$", _DIGITS + _UPPER + _LOWER),
    (r"^[A-Za-z0-9+/]+=*$", _DIGITS + _UPPER + _LOWER + "+/"),
    (r"", _DIGITS + _UPPER + _LOWER + "-_+/="),
)
ONE_KIND = 2  # encodings whose tokens have one kind of characters

# How often letters stand in texts of European languages, in percent; one letter in ten is any.
_LETTERS = dict(zip(_LOWER, (8.6, 1.5, 3.3, 4.3, 14.7, 1.5, 1.7, 3.1, 7.1, 0.35, 0.6, 4.4, 2.6, 7.8, 5.4, 2.1, 0.7, 6.6, 7.2, 6.9, 4.2, 1.2, 1.1, 0.3, 1.1, 0.6)))
ANY = 0.1
STAYS = 0.85  # probability that a character is of the kind of the one before


def _ordinary() -> list[tuple[str, int, float]]:
    """Characters with their kind and the binary logarithm of their share of it in ordinary text."""
    total = sum(_LETTERS.values())
    out = [(c, n, math.log2((1 - ANY) * _LETTERS[c.lower()] / total + ANY / 26)) for n, kind in enumerate((_LOWER, _UPPER)) for c in kind]
    return out + [(c, n, -math.log2(len(kind))) for n, kind in ((2, _DIGITS), (3, _SIGNS)) for c in kind]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def spans(kind: str, pattern: str) -> Column:
    """All places of a pattern: array of (start, end, kind, value), counted in code points.

    Lengths are added up within groups of TOGETHER matches and then over the groups, so the cost grows with the matches.
    """
    values = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    before = F.split("text", pattern, -1)
    start = F.struct(
        F.array().cast("array<struct<start:int,end:int,kind:string,value:string>>").alias("spans"), F.lit(0).alias("at")
    )

    def add(a: Column, x: Column) -> Column:
        def placed(begin: Column) -> Column:
            end = begin + F.char_length(x.value)
            one = F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x.value.alias("value"))
            return F.struct(F.array_append(a.spans, one).alias("spans"), end.alias("at"))

        return _let(a.at + F.char_length(x.before), placed)

    def grouped(pairs: Column) -> Column:
        groups = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / TOGETHER).cast("int"))
        return F.transform(groups, lambda g: F.aggregate(F.slice(pairs, g * TOGETHER + 1, F.lit(TOGETHER)), start, add))

    def moved(groups: Column) -> Column:
        none = F.struct(F.array().cast("array<int>").alias("offsets"), F.lit(0).alias("at"))
        offsets = F.aggregate(groups, none, lambda a, g: F.struct(F.array_append(a.offsets, a.at).alias("offsets"), (a.at + g.at).alias("at")), lambda a: a.offsets)

        def by(g: Column, offset: Column) -> Column:
            return F.transform(g.spans, lambda s: F.struct((s.start + offset).alias("start"), (s.end + offset).alias("end"), s.kind.alias("kind"), s.value.alias("value")))

        return F.flatten(F.zip_with(groups, offsets, by))

    pairs = F.filter(F.arrays_zip(before.alias("before"), values.alias("value")), lambda x: x.value.isNotNull())
    found = _let(_let(pairs, grouped), moved)
    return F.when(F.col("text").rlike(pattern), found).otherwise(start.spans)


def _tail(z: Column) -> Column:
    """Probability of more than z, between -8 and 8, under the normal law, by its usual logistic approximation."""
    return 1 / (1 + F.exp(1.5976 * z + 0.070565992 * z * z * z))


def battery(value: Column) -> Column:
    """(encoding, length, chi, runs, serial, bits, p) of a token, the tests as normal deviates: p is high if it may be random, bits is the binary logarithm of its e value; null for numbers."""
    encoding = F.lit(None)
    for n, (pattern, _) in reversed(list(enumerate(ENCODINGS))):
        encoding = F.when(value.rlike(pattern), F.lit(n)).otherwise(encoding)
    alphabets = F.array(*[F.lit(a) for _, a in ENCODINGS])
    written = F.when(value.rlike(_TITLE), F.lower(value)).otherwise(value)
    token = F.struct(written.alias("value"), encoding.alias("encoding"))
    ordinary = _ordinary()
    known = F.lit("".join(c for c, *_ in ordinary))
    kinds, shares = F.array(*[F.lit(n) for _, n, _ in ordinary]), F.array(*[F.lit(v) for *_, v in ordinary])

    def numbers(t: Column) -> Column:
        def coded(alphabet: Column) -> Column:
            symbols = F.split(F.rtrim(t.value, F.lit("=")), "")
            codes = F.transform(symbols, lambda c: F.instr(alphabet, c).cast("double"))
            at = F.transform(symbols, lambda c: F.instr(known, c) - 1)
            return F.struct(at.alias("at"), codes.alias("x"), F.char_length(alphabet).cast("double").alias("k"), t.encoding.alias("encoding"))

        return _let(F.get(alphabets, t.encoding), coded)

    def counted(t: Column) -> Column:
        """Sums over the symbols, of which each is asked for once."""
        n, zero, middle = F.size(t.x).cast("double"), F.lit(0.0), (t.k + 1) / 2
        # of equal symbols in a row, the first adds 1 to the sum of squared counts, the second 3, the third 5
        first = F.struct(F.lit(-1.0).alias("last"), F.lit(0.0).alias("same"), F.lit(0.0).alias("total"))

        def squared(a: Column, v: Column) -> Column:
            return _let(
                F.when(a.last == v, a.same + 1).otherwise(0.0),
                lambda same: F.struct(v.alias("last"), same.alias("same"), (a.total + 2 * same + 1).alias("total")),
            )

        kind = F.transform(t["at"], lambda i: F.get(kinds, i))
        return F.struct(
            t.encoding.alias("encoding"),
            t.k.alias("k"),
            n.alias("n"),
            t.x.alias("x"),
            middle.alias("middle"),
            F.aggregate(F.array_sort(t.x), first, squared, lambda a: a.total).alias("squares"),
            F.aggregate(t.x, zero, lambda a, v: a + F.when(v > middle, 1.0).otherwise(0.0)).alias("high"),
            (F.aggregate(t.x, zero, lambda a, v: a + v) / n).alias("mean"),
            F.aggregate(t["at"], zero, lambda a, i: a + F.get(shares, i)).alias("shares"),
            _let(kind, lambda k: F.size(F.filter(F.transform(F.slice(k, 1, F.size(k) - 1), lambda v, i: v == F.get(k, i + 1)), lambda v: v))).alias("stays"),
        )

    def compared(t: Column) -> Column:
        """The three statistics as normal deviates."""
        freedom = t.k - 1
        rest = F.slice(t.x, F.lit(1), F.size(t.x) - 1)
        mean_runs = 2 * t.high * (t.n - t.high) / t.n + 1
        runs = F.aggregate(
            F.transform(rest, lambda v, i: (v > t.middle) != (F.get(t.x, i + 1) > t.middle)), F.lit(1.0), lambda a, v: a + F.when(v, 1.0).otherwise(0.0)
        )
        spread = F.aggregate(t.x, F.lit(0.0), lambda a, v: a + (v - t.mean) * (v - t.mean))
        joint = F.aggregate(
            F.transform(rest, lambda v, i: (v - t.mean) * (F.get(t.x, i + 1) - t.mean)), F.lit(0.0), lambda a, v: a + v
        )
        z_chi = _let(
            F.greatest(t.squares * t.k / t.n - t.n, F.lit(0.0)),
            lambda chi: (F.cbrt(chi / freedom) - (1 - 2 / (9 * freedom))) / F.sqrt(2 / (9 * freedom)),
        )
        z_runs = _let(
            mean_runs,
            lambda m: _let((m - 1) * (m - 2) / F.greatest(t.n - 1, F.lit(1.0)), lambda var: F.when(var > 0, F.abs(runs - m) / F.sqrt(var)).otherwise(8.0)),
        )
        z_serial = _let(spread, lambda all_of: F.when(all_of > 0, F.abs(joint / all_of) * F.sqrt(t.n)).otherwise(8.0))
        steps = t.stays * math.log2(STAYS) + (t.n - 1 - t.stays) * math.log2((1 - STAYS) / 3) - 2
        written = t.shares + F.when(t.encoding >= ONE_KIND, steps).otherwise(0.0)
        return F.struct(
            t.encoding.alias("encoding"),
            F.size(t.x).alias("length"),
            z_chi.alias("chi"),
            z_runs.alias("runs"),
            z_serial.alias("serial"),
            (-t.n * F.log2(t.k) - written).alias("bits"),
        )

    def combined(t: Column) -> Column:
        tails = [_let(F.least(F.greatest(z, F.lit(-8.0)), F.lit(8.0)), _tail) for z in (t.chi, t.runs, t.serial)]
        fisher = -(F.ln(tails[0]) + F.ln(2 * tails[1]) + F.ln(2 * tails[2]))
        p = _let(fisher, lambda x: F.least(F.exp(-x) * (1 + x + x * x / 2), F.lit(1.0)))
        return F.struct(*[t[c].alias(c) for c in ("encoding", "length", "chi", "runs", "serial", "bits")], p.alias("p"))

    result = _let(_let(_let(_let(token, numbers), counted), compared), combined)
    return F.when(~value.rlike(r"^[0-9]+$") & (F.char_length(F.rtrim(value, F.lit("="))) > 2), result)


def scanned(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base spans, and tested tokens with their group (encoding and band of lengths) and bits of the e value."""
    assigned = KINDS["assign"]
    base = F.concat(
        F.filter(spans("assign", assigned), lambda s: F.char_length(F.regexp_extract(s.value, assigned, 1)) >= LEAST_ASSIGNED),
        spans("access", KINDS["access"]),
        spans("hex", KINDS["hex"]),
    )
    plain = F.transform(base, lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind")))

    def tested(s: Column) -> Column:
        return F.struct(s.start.alias("start"), s.end.alias("end"), battery(s.value).alias("t"))

    tokens = F.filter(F.transform(spans(RANDOM, TOKEN), tested), lambda s: s.t.isNotNull())
    tokens = F.transform(
        tokens,
        lambda s: F.struct(
            s.start.alias("start"),
            s.end.alias("end"),
            (s.t.encoding * 100 + F.floor(F.log2(s.t.length.cast("double")) * 2)).cast("int").alias("group"),
            F.when(s.t.p < LEAST_P, 0).otherwise(F.greatest(F.least(F.floor(s.t.bits), F.lit(MOST_BITS)), F.lit(0))).cast("int").alias("bits"),
        ),
    )
    return texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), plain.alias("base"), tokens.alias("tokens"))


def least_bits(tokens: DataFrame, rate: float) -> dict[int, int]:
    """For each group of tokens that has discoveries, the lowest bits of an e value that is one."""
    # groups times MOST_BITS
    histogram = tokens.where("group is not null").groupBy("group", "bits").count().collect()
    out = {}
    for group in sorted({r.group for r in histogram}):
        counts = [0] * (MOST_BITS + 1)
        for r in histogram:
            if r.group == group:
                counts[r.bits] += r["count"]
        found = 0
        for at in range(MOST_BITS, 0, -1):
            found += counts[at]
            if counts[at] and 2.0**at * rate * found >= sum(counts):
                out[group] = at
    return out


def secret_spans(docs: DataFrame, *, rate: float = RATE) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    rows = stored(scanned(docs), "secret_tokens")
    least = least_bits(rows.select(F.inline("tokens")), rate)
    groups = F.create_map(*[F.lit(v) for pair in least.items() for v in pair]) if least else None
    if groups is None:
        random = F.filter("tokens", lambda s: F.lit(False))
    else:
        random = F.filter("tokens", lambda s: s.bits >= F.coalesce(groups[s.group], F.lit(MOST_BITS + 1)))
    random = F.transform(random, lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), F.lit(RANDOM).alias("kind")))
    order = F.array(*[F.lit(k) for k in (*KINDS, RANDOM)])

    def joined(found: Column) -> Column:
        keyed = F.transform(found, lambda s: F.struct(s.start, F.array_position(order, s.kind), s.end, s.kind.alias("kind")))
        shown = F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s.kind, s["start"].cast("string"), s["end"].cast("string")))
        return F.concat_ws(",", shown)

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *[number(k) for k in KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", random)).alias("spans"),
        F.size(random).cast("long").alias("n_random"),
    )
