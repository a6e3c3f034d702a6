"""Secret scans: patterns, and a pair of character Markov models.

Besides what patterns find, a token of ``TOKEN_CHARS`` or more is a secret if a first-order
Markov model of random strings explains its characters better than one of ordinary
identifiers, by the logarithm of their likelihoods' ratio. Both models are counted from
labelled samples with Spark: the random ones are digests in several spellings and what the
patterns found, the ordinary ones words, identifiers and numbers. Their ratio of each pair of
characters becomes a constant table in a column expression, so scanning is one pass of
built-in functions without shuffle or Python.

Places are counted in code points, ends are exclusive. Spans of one kind do not overlap;
a span that the models add overlaps no span of a pattern. Of a token around such a span the
parts outside are judged each, from four characters on. The work on a text grows with its length and
its matches, not with their square.

Defined results: null and empty texts have no spans. Characters outside the table end a
token. Without any sample text the ordinary words are those of a fixed list of
identifiers alone. Repeated rows are each scanned; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the kinds, in the order in which equal starts are listed.
ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_VALUE = 6  # characters at least
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
BASE_KINDS = ("assign", "access", "hex")
MODEL_KIND = "random"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN_CHARS = 16
EDGE_CHARS = 4  # of a token's part that borders a pattern's span
TOKEN = "[A-Za-z0-9+/_=-]{16,}"
EDGE_TOKEN = f"{TOKEN}|^[A-Za-z0-9+/_=-]{{4,}}|[A-Za-z0-9+/_=-]{{4,}}$"  # of a stretch beside a span
MIN_RATIO = 10.0  # natural logarithm of the likelihoods' ratio of a token
MIN_RATIO_PER_CHAR = 0.6

SAMPLE_TEXTS = 500  # about as many texts are taken as samples of ordinary words
SAMPLE_RANDOM = 400  # digests, each in several spellings
SMOOTHING = 0.5
PLACEHOLDER = "[SECRET]"
CHUNK = 256  # elements of an array that grows
BLOCK = 1024  # code points of a text that are walked through to cut a piece out of it

# Identifiers as they stand in code and settings.
IDENTIFIERS = (
    "get_user_by_name max_retry_count connection-timeout-seconds HttpRequestHandler parseJsonDocument "
    "application/x-www-form-urlencoded content-security-policy spark_sql_shuffle_partitions "
    "XMLHttpRequest OutOfMemoryError testShouldReturnEmptyList README_first_before_install "
    "background-color font-family border-radius organization/repository/branch-name usr/local/share/doc "
    "2024-05-17T12-30-00 release-2-14-1 build_20240517_1230 IMAGE_FORMAT_VERSION_2 MAX_BUFFER_LENGTH"
)

_SPAN = "array<struct<start:int,place:int,end:int,kind:string>>"


@dataclass(frozen=True)
class Model:
    """Log ratio, random to ordinary, of each character after each other one."""

    ratios: list[float]  # by 'first * len(ALPHABET) + second'


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _before(values: Column, of: Callable[[Column], Column], combine: Callable[[Column, Column], Column]) -> Column:
    """For each element, what its predecessors come to (a number, 0 at first).

    An array that grows element by element is copied each time, so only chunks of ``CHUNK`` grow,
    and one of the chunks' totals: this keeps long arrays from costing their square.
    """
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def grown(chunk: Column, at: Column, value: Callable[[Column], Column]) -> Column:
        begin = F.struct(at.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            chunk,
            begin,
            lambda acc, x: F.struct(
                combine(acc["at"], value(x)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")
            ),
            lambda acc: acc["out"],
        )

    def parts(whole: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(whole) - 1, F.lit(0)), F.lit(CHUNK))
        return F.transform(starts, lambda i: F.slice(whole, i + 1, F.lit(CHUNK)))

    def heads(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda acc, x: combine(acc, of(x))))
        return grown(totals, zero["at"], lambda x: x)

    return _bound(
        values,
        lambda whole: _bound(
            parts(whole),
            lambda chunks: F.flatten(F.zip_with(chunks, heads(chunks), lambda c, h: grown(c, h, of))),
        ),
    )


def _add(a: Column, b: Column) -> Column:
    return a + b


def _spans(text: Column, pattern: str, kind: str, value_chars: int = 0) -> Column:
    """Every match of a pattern as start, place in the kinds' order, end and kind.

    Text between matches and the matches themselves alternate, so the running sum of their
    lengths gives the places. ``value_chars``: a match counts if its second group has as many.
    """
    place = (*BASE_KINDS, MODEL_KIND).index(kind)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if value_chars else found
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(found, F.length).alias("size"),
        F.transform(value, F.length).alias("value"),
    )  # one gap more than matches

    def span(part: Column, before: Column) -> Column:
        start = before + part["gap"]
        end = start + part["size"]
        fields = [start.alias("start"), F.lit(place).alias("place"), end.alias("end"), F.lit(kind).alias("kind")]
        return F.when(part["size"].isNotNull() & (part["value"] >= value_chars), F.struct(*fields))

    def length(part: Column) -> Column:
        return part["gap"] + F.coalesce(part["size"], F.lit(0))

    all_of_them = _bound(parts, lambda p: F.array_compact(F.zip_with(p, _before(p, length, _add), span)))
    return F.when(text.rlike(pattern), all_of_them.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def _blocks(text: Column) -> Column:
    """The text in pieces of ``BLOCK`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _cut(blocks: Column, start: Column, end: Column) -> Column:
    """Code points from ``start`` to ``end``, without a walk from the start of the text."""
    first = F.floor(start / BLOCK).cast("int")
    last = F.floor(F.greatest(end - 1, start) / BLOCK).cast("int")
    near = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
    return F.when(end > start, F.substring(near, start - first * BLOCK + 1, end - start)).otherwise("")


def _regions(spans: Column) -> Column:
    """The stretches that spans cover: (start, end), those that overlap as one."""

    def opened(ordered: Column) -> Column:
        ends = _before(ordered, lambda s: s["end"], F.greatest)
        pairs = F.zip_with(ordered, ends, lambda s, e: F.struct(s["start"].alias("start"), s["end"].alias("end"), e.alias("reach")))
        return F.transform(F.array(pairs), closed)[0]

    def closed(pairs: Column) -> Column:
        # A span that starts where all before it have ended opens a region, which ends at what
        # the next one that does has before it, the last region at the farthest end of all.
        opening = F.filter(pairs, lambda p: p["start"] >= p["reach"])
        farthest = F.aggregate(pairs, F.lit(0), lambda acc, p: F.greatest(acc, p["end"]))
        reaches = F.concat(F.slice(F.transform(opening, lambda p: p["reach"]), F.lit(2), F.size(opening)), F.array(farthest))
        return F.zip_with(opening, reaches, lambda p, e: F.struct(p["start"].alias("start"), e.alias("end")))

    return _bound(F.array_sort(spans), opened)


def _outside(regions: Column, length: Column) -> Column:
    """What lies in front of, between and behind regions: (start, end), empty ones included."""
    starts = F.concat(F.array(F.lit(0)), F.transform(regions, lambda r: r["end"]))
    ends = F.concat(F.transform(regions, lambda r: r["start"]), F.array(length))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), b.alias("end")))


def base_spans(text: Column) -> Column:
    """What the patterns find, by start, then kind."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(
        F.concat(
            _spans(text, ASSIGN, "assign", ASSIGN_VALUE), _spans(text, ACCESS, "access"), _spans(text, HEX, "hex")
        )
    )


def _ratio_of(model: Model, token: Column) -> Column:
    """The log ratio of a token's characters."""
    table = F.split(F.lit(",".join(repr(r) for r in model.ratios)), ",").cast("array<double>")
    codes = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    n = F.size(codes) - 1
    pairs = F.zip_with(F.slice(codes, F.lit(1), n), F.slice(codes, F.lit(2), n), lambda a, b: a * len(ALPHABET) + b)
    return F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + F.get(table, p))


def model_spans(text: Column, base: Column, model: Model) -> Column:
    """Tokens outside the spans of ``base`` that look random.

    What a token has in front of or behind a span is judged by itself, from ``EDGE_CHARS`` on.
    """
    text = F.coalesce(text, F.lit(""))

    def random(token: Column) -> Column:
        size = F.length(token)
        return _bound(
            _ratio_of(model, token),
            lambda ratio: (ratio >= MIN_RATIO_PER_CHAR * size) & ((size < TOKEN_CHARS) | (ratio >= MIN_RATIO)),
        )

    def found(stretch: Column, start: Column, size: Column, length: Column, pattern: str) -> Column:
        """Random tokens of a stretch of ``size`` code points from ``start``, of a text of ``length``."""

        def judged(s: Column) -> Column:
            whole = s["end"] - s["start"] >= TOKEN_CHARS
            return whole | ((start > 0) & (s["start"] == 0)) | ((start + size < length) & (s["end"] == size))

        def looks_random(blocks: Column) -> Column:
            tokens = F.filter(_spans(stretch, pattern, MODEL_KIND), judged)
            return F.filter(tokens, lambda s: random(_cut(blocks, s["start"], s["end"])))

        def moved(s: Column) -> Column:
            places = [(s["start"] + start).alias("start"), s["place"].alias("place"), (s["end"] + start).alias("end")]
            return F.struct(*places, s["kind"].alias("kind"))

        tokens = F.transform(_bound(_blocks(stretch), looks_random), moved)
        return F.when(stretch.rlike(pattern), tokens).otherwise(F.array().cast(_SPAN))

    def between(blocks: Column, length: Column) -> Column:
        free = F.filter(_outside(_regions(base), length), lambda r: r["end"] > r["start"])

        def tokens(r: Column) -> Column:
            cut = _cut(blocks, r["start"], r["end"])
            return _bound(cut, lambda stretch: found(stretch, r["start"], r["end"] - r["start"], length, EDGE_TOKEN))

        return F.flatten(F.transform(free, tokens))

    def anywhere(length: Column) -> Column:  # the length takes a walk through the text, so it is bound
        apart = _bound(_blocks(text), lambda blocks: between(blocks, length))
        return F.when(F.size(base) == 0, found(text, F.lit(0), length, length, TOKEN)).otherwise(apart)

    return _bound(F.length(text), anywhere).cast(_SPAN)


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def as_text(spans: Column) -> Column:
    one = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(one, ",")


def samples(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Labelled tokens: rows (random boolean, token)."""
    spark = docs.sparkSession
    rows = max(1, docs.count())
    draw = F.pmod(F.xxhash64(key), F.lit(1_000_003)) / 1_000_003
    drawn = docs.filter(draw < SAMPLE_TEXTS / rows).select(F.coalesce(text, F.lit("")).alias("text"))
    drawn = drawn.limit(2 * SAMPLE_TEXTS)
    base = drawn.withColumn("base", base_spans(F.col("text")))
    found = base.select(F.explode("base").alias("s"), "text").select(
        F.lit(True).alias("random"), F.expr("substring(text, s.start + 1, s.end - s.start)").alias("token")
    )
    found = found.withColumn("token", F.regexp_extract("token", "[A-Za-z0-9+/_=-]+$", 0))
    words = F.filter(F.split("text", "[^A-Za-z0-9]+"), lambda w: F.length(w) >= 3)
    letters = drawn.select(F.filter(words, lambda w: ~w.rlike("[0-9]")).alias("w"))
    # A word by itself and, as identifiers are made, joined to the next one.
    joined = F.array(
        *[F.lit(x) for x in ("", "_", "-", "/")]
    )
    pair = "transform(sequence(0, greatest(size(w) - 2, 0), 5), i -> struct(get(w, i) as a, get(w, i + 1) as b, i))"
    pairs = letters.select(F.explode(F.expr(pair)).alias("p"), joined.alias("j")).filter("p.b is not null")
    named = pairs.select(
        F.concat("p.a", F.get("j", F.pmod(F.col("p.i") / 5, F.lit(4)).cast("int")), F.initcap("p.b")).alias("token")
    )
    spread = spark.range(SAMPLE_RANDOM).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    packed = F.base64(F.unhex("h"))
    digits = F.regexp_replace(F.col("h"), "[a-f]", "")
    made_random = spread.select(
        F.explode(
            F.array("h", packed, F.reverse(packed), F.translate(packed, "+/", "-_"), F.upper(F.regexp_replace(packed, "[+/=]", "")))
        ).alias("token")
    )
    fixed = spark.range(20).select(F.explode(F.split(F.lit(IDENTIFIERS), " ")).alias("token"))
    ordinary = [letters.select(F.explode("w").alias("token")), named, spread.select(digits.alias("token")), fixed]
    out = made_random.select(F.lit(True).alias("random"), "token").union(found)
    for tokens in ordinary:
        out = out.union(tokens.select(F.lit(False).alias("random"), "token"))
    return out.filter("length(token) >= 2")


def fit(labelled: DataFrame) -> Model:
    """The models' ratio from tokens labelled random or not; at most one row per pair of
    characters and label reaches the driver."""
    places = F.sequence(F.lit(1), F.length("token") - 1)
    pairs = labelled.select("random", F.explode(F.transform(places, lambda i: F.substring("token", i, F.lit(2)))).alias("pair"))
    known = pairs.filter(F.col("pair").rlike("^[A-Za-z0-9+/_=-]{2}$"))
    counts = {(r["random"], r["pair"]): r["count"] for r in known.groupBy("random", "pair").count().collect()}
    n = len(ALPHABET)
    logs = []
    for kind in (True, False):
        rows = []
        for a in ALPHABET:
            row = [counts.get((kind, a + b), 0) + SMOOTHING for b in ALPHABET]
            rows += [math.log(x / sum(row)) for x in row]
        logs.append(rows)
    return Model([round(logs[0][i] - logs[1][i], 6) for i in range(n * n)])


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with two more columns, ``base`` and ``added``: the patterns' and the models' spans."""
    found = docs.withColumn("base", base_spans(F.col(text)))
    return found.withColumn("added", model_spans(F.col(text), F.col("base"), model))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by a placeholder, overlapping ones by one."""

    def kept(blocks: Column) -> Column:
        pieces = F.transform(_outside(_regions(spans), F.length(text)), lambda r: _cut(blocks, r["start"], r["end"]))
        return F.array_join(pieces, PLACEHOLDER)

    return F.when(F.size(spans) > 0, _bound(_blocks(text), kept)).otherwise(text)
