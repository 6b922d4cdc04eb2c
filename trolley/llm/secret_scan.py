"""Secret scans: fixed forms, and character Markov models of random strings.

Base spans are what three patterns find. The method adds spans of kind ``random``: long
tokens whose characters follow each other as in random strings rather than as in
ordinary identifiers. Two Markov models of order one are learned, one from samples that are
labelled secret (the values of base spans), one from samples labelled ordinary (words and
identifiers outside of them), both of all documents; a token is a secret if the log-likelihood ratio per
character passes a threshold. All of it is built-in functions: positions come from cutting a
text at a pattern and adding up the lengths of the pieces. The time of a text grows with its
length, however many spans it has.

A null text is an empty text. Rows are scanned each for itself, whatever their ids; other
columns are not looked at. Where the samples hold no secret, random strings are taken
to be uniform over the characters.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.shared import text_of

# The base patterns, and the fewest characters of a match or its value.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
FEWEST = {"assign": 8, "access": 16, "hex": 32}
#: Shorter runs never count, and whole runs are found, so they need not be looked at.
LONG_ACCESS, LONG_HEX = "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
#: Maximal runs of these characters are tokens; shorter ones say too little.
CHARACTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
TOKEN, FEWEST_TOKEN = "[A-Za-z0-9+/_=-]{20,}", 20
#: Ordinary samples: words and identifiers that are too short to be judged, so that what
#: is judged is not learned from.
ORDINARY = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{4,19}(?![A-Za-z0-9+/_=-])"
#: Natural log units per character by which a token has to look more random.
THRESHOLD = 0.5
#: Pairs that the frequency of the second character counts for.
SMOOTHING = 20.0
_SIZE = len(CHARACTERS) + 1
_SPANS = "array<struct<kind:string,first:int,last:int,value:string>>"
#: Spans are gathered in groups of so many, as appending copies the array.
_GROUP = 256
#: Stands for a character of a token within a base span.
_COVERED = "\x01"


def _none() -> Column:
    return F.array().cast(_SPANS)


def _parts(text: Column, pattern: str, group: int = 0) -> Column:
    """The pieces between the matches, each with the match behind it (the last: null)."""
    wholes = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else wholes
    return F.arrays_zip(
        F.split(text, pattern, -1).alias("piece"),
        wholes.alias("whole"),
        values.alias("value"),
    )


def _placed(parts: Column, kind: str, wanted: Callable[[Column], Column]) -> Column:
    """The matches that are ``wanted``, in order; each stands after what is before it."""
    start = F.struct(
        F.lit(0).alias("at"),
        _none().alias("open"),
        F.array().cast(f"array<{_SPANS}>").alias("full"),
    )

    def add(acc: Column, part: Column) -> Column:
        first = acc["at"] + F.length(part["piece"])
        # The last piece has no match after it.
        last = first + F.coalesce(F.length(part["whole"]), F.lit(0))
        span = F.struct(
            F.lit(kind).alias("kind"),
            first.alias("first"),
            last.alias("last"),
            part["value"].alias("value"),
        )
        take = wanted(part)
        fills = take & (F.size(acc["open"]) >= _GROUP)
        return F.struct(
            last.alias("at"),
            F.when(fills, F.array(span))
            .when(take, F.concat(acc["open"], F.array(span)))
            .otherwise(acc["open"])
            .alias("open"),
            F.when(fills, F.concat(acc["full"], F.array(acc["open"])))
            .otherwise(acc["full"])
            .alias("full"),
        )

    return F.aggregate(
        parts, start, add, lambda acc: F.concat(F.flatten(acc["full"]), acc["open"])
    )


def _spans(text: Column, pattern: str, kind: str, fewest: int, group: int = 0) -> Column:
    """The matches that have ``fewest`` characters in ``group``, in order."""
    found = _placed(
        _parts(text, pattern, group), kind, lambda part: F.length(part["value"]) >= fewest
    )
    return F.when(text.rlike(pattern), found).otherwise(_none())


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text, assign, access, hex): the spans of each kind in order."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    text = F.col("text")
    return rows.select(
        "doc_id",
        "text",
        _spans(text, ASSIGN, "assign", FEWEST["assign"], 2).alias("assign"),
        _spans(text, LONG_ACCESS, "access", FEWEST["access"]).alias("access"),
        _spans(text, LONG_HEX, "hex", FEWEST["hex"]).alias("hex"),
    )


def _pairs(token: Column) -> Column:
    """Numbers of the pairs of characters that follow each other in a token."""
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(CHARACTERS), c))
    inner = F.size(codes) - 1
    return F.zip_with(
        F.slice(codes, F.lit(1), inner),
        F.slice(codes, F.lit(2), inner),
        lambda a, b: a * F.lit(_SIZE) + b,
    )


def _is_free(text: Column, pattern: str, fewest: int, group: int = 0) -> Column:
    """For each token of the text: it shares no character with a span of this pattern.

    Token characters of the spans are covered by a sign that counts as one, so that the
    tokens stay where they are.
    """
    def clear(piece: Column) -> Column:
        return F.translate(piece, _COVERED, " ")

    covered = F.transform(
        _parts(text, pattern, group),
        lambda part: F.concat(
            clear(part["piece"]),
            F.when(
                F.length(part["value"]) >= fewest,
                F.translate(part["whole"], CHARACTERS, _COVERED * len(CHARACTERS)),
            ).otherwise(F.coalesce(part["whole"], F.lit(""))),
        ),
    )
    masked = F.when(text.rlike(pattern), F.array_join(covered, "")).otherwise(clear(text))
    runs = F.regexp_extract_all(masked, F.lit(TOKEN.replace("[", f"[{_COVERED}", 1)), F.lit(0))
    return F.transform(runs, lambda run: F.instr(run, _COVERED) == 0)


def labelled_samples(docs: DataFrame) -> DataFrame:
    """(secret, token): samples of both labels from all documents.

    Secret: the values of base spans. Ordinary: words and identifiers of what is left.
    """
    text, rest = F.col("text"), F.col("text")
    for pattern in (ASSIGN, LONG_ACCESS, LONG_HEX):
        rest = F.regexp_replace(rest, pattern, " ")

    def values(pattern: str, kind: str, group: int = 0) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        return F.filter(found, lambda value: F.length(value) >= FEWEST[kind])

    def labelled(tokens: Column, secret: bool) -> Column:
        return F.transform(
            tokens, lambda token: F.struct(F.lit(secret).alias("secret"), token.alias("token"))
        )

    secret = F.concat(
        values(ASSIGN, "assign", 2), values(LONG_ACCESS, "access"), values(LONG_HEX, "hex")
    )
    ordinary = F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0))
    return docs.select(text_of().alias("text")).select(
        F.inline(F.concat(labelled(secret, True), labelled(ordinary, False)))
    )


def fit(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios of all pairs of characters, by pair number.

    Spark counts the samples, each task those it has seen, and the pairs of each distinct
    one; the driver gets one row for each pair and label at most.
    """
    counted = (
        samples.groupBy("secret", "token")
        .count()
        .select("secret", F.explode(_pairs(F.col("token"))).alias("pair"), "count")
        .groupBy("secret", "pair")
        .agg(F.sum("count").alias("count"))
    )
    counts = {True: [0.0] * _SIZE**2, False: [0.0] * _SIZE**2}
    for row in counted.collect():
        counts[row.secret][row.pair] = float(row["count"])
    secret, ordinary = (_log_chances(counts[label]) for label in (True, False))
    return [a - b for a, b in zip(secret, ordinary)]


def _log_chances(counts: list[float]) -> list[float]:
    """Log of the chance of each character after each other one, by pair number.

    Counts of a pair are smoothed by the frequency of its second character, and that by
    the uniform distribution.
    """
    rows = [counts[a * _SIZE : (a + 1) * _SIZE] for a in range(_SIZE)]
    by_second = [sum(column) + 0.5 for column in zip(*rows)]
    total = sum(by_second)
    out = []
    for row in rows:
        weight = sum(row) + SMOOTHING
        out += [
            math.log((n + SMOOTHING * m / total) / weight) for n, m in zip(row, by_second)
        ]
    return out


def with_random_spans(
    found: DataFrame, ratios: list[float], threshold: float = THRESHOLD
) -> DataFrame:
    """``base_spans`` with a column ``random``: tokens outside of them that look random."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    text = F.col("text")
    held = F.arrays_zip(
        _parts(text, TOKEN).alias("part"),
        _is_free(text, ASSIGN, FEWEST["assign"], 2).alias("assign"),
        _is_free(text, LONG_ACCESS, FEWEST["access"]).alias("access"),
        _is_free(text, LONG_HEX, FEWEST["hex"]).alias("hex"),
    )

    def looks_random(token: Column) -> Column:
        total = F.aggregate(
            _pairs(token), F.lit(0.0), lambda acc, pair: acc + F.get(table, pair)
        )
        return total / (F.length(token) - 1) > threshold

    parts = F.transform(
        held,
        lambda x: F.struct(
            x["part"]["piece"].alias("piece"),
            x["part"]["whole"].alias("whole"),
            x["part"]["value"].alias("value"),
            # The part behind the last token has none.
            F.coalesce(
                x["assign"] & x["access"] & x["hex"] & looks_random(x["part"]["value"]),
                F.lit(False),
            ).alias("random"),
        ),
    )
    found_spans = _placed(parts, "random", lambda part: part["random"])
    return found.withColumn("random", F.when(text.rlike(TOKEN), found_spans).otherwise(_none()))


def span_text(*kinds: str) -> Column:
    """kind:start:end of the spans of these columns, by start, then kind as listed."""
    order = F.array(*[F.lit(kind) for kind in KINDS])
    spans = F.concat(*[F.col(kind) for kind in kinds])
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["first"].alias("first"),
            F.array_position(order, s["kind"]).alias("place"),
            F.concat_ws(":", s["kind"], s["first"], s["last"]).alias("said"),
        ),
    )
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: s["said"]), ",")


def scanned(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, assign, access, hex, random): arrays of spans of each whole text."""
    found = base_spans(docs)
    ratios = fit(labelled_samples(docs))
    return with_random_spans(found, ratios, threshold).drop("text")
