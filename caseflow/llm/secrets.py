"""Secret scans with DataFrame functions only.

Base spans come from three patterns. The method then looks at every other long run of token characters
and compares two character Markov models, one of random strings and one of ordinary identifiers, by
their log-likelihood ratio. Both models are counted from labelled samples by Spark; the ratio of every
character pair is a literal table of the alphabet's size, so scoring is a projection.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import materialise

# The base patterns
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"  # runs are matched whole, so a shorter one can hide no match
HEX = r"[0-9a-f]{32,}"
ASSIGN_CHARS = 8
BASE_KINDS = ("assign", "access", "hex")
MARKOV = "markov"

# Candidates of the Markov test, and the ratio (natural logarithm) from which one is a secret.
CANDIDATE = r"[A-Za-z0-9][A-Za-z0-9+/_=-]{19,}"
CANDIDATE_CHARS = 20
RATIO = 10.0
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Different texts, on average, whose words are the sample of ordinary identifiers, and rows of random strings.
TRAIN_DOCUMENTS = 2000
REDACTED = "[REDACTED]"
SCAN_BLOCK = 256


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.transform(F.array(value), then)[0]


# --- spans --------------------------------------------------------------------


def _running(steps: Column) -> Column:
    """Begin and end of every step (gap, size) of a short array."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    first = F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("out"))

    def add(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        end = start + step["size"]
        one = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.concat(state["out"], one).alias("out"))

    return F.aggregate(steps, first, add, lambda state: state["out"])


def _positions(steps: Column) -> Column:
    """Begin and end of every step, in blocks, so that many matches in a text stay cheap."""

    def blocks_of(all_steps: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_steps) - 1) / SCAN_BLOCK).cast("int")),
            lambda b: F.slice(all_steps, b * SCAN_BLOCK + 1, F.lit(SCAN_BLOCK)),
        )

    def place(blocks: Column) -> Column:
        zero = F.lit(0).cast("bigint")
        totals = F.transform(
            blocks,
            lambda b: F.struct(
                zero.alias("gap"),
                F.aggregate(b, zero, lambda n, s: n + s["gap"] + s["size"]).alias("size"),
            ),
        )
        shifted = F.zip_with(
            blocks,
            _running(totals),
            lambda b, whole: F.transform(
                _running(b),
                lambda s: F.struct(
                    (s["start"] + whole["start"]).alias("start"), (s["end"] + whole["start"]).alias("end")
                ),
            ),
        )
        return F.flatten(shifted)

    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return let(steps, lambda s: F.when(F.size(s) == 0, nothing).otherwise(let(blocks_of(s), place)))


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, text>> of the leftmost non-overlapping matches, in code points, end
    exclusive. The text between matches tells where they stand."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def place(hits: Column) -> Column:
        # one more gap than matches: the rest of the text
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
        steps = F.zip_with(
            gaps, hits,
            lambda g, h: F.struct(F.length(g).cast("bigint").alias("gap"), F.length(h).cast("bigint").alias("size")),
        )
        return F.zip_with(
            _positions(steps), hits, lambda p, h: F.struct(p["start"].alias("start"), p["end"].alias("end"), h.alias("text"))
        )

    return let(found, place)


_SPANS = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def _spans(found: Column, kind: str) -> Column:
    rank = (*BASE_KINDS, MARKOV).index(kind)
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def base_spans(text: Column) -> Column:
    """Spans (start, rank, end, kind) of the base patterns by start, then kind as listed."""
    none = F.array().cast(_SPANS)

    def assigned(hits: Column) -> Column:
        values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
        both = F.arrays_zip(hits.alias("m"), F.transform(values, F.length).alias("n"))
        return F.transform(F.filter(both, lambda x: x["n"] >= ASSIGN_CHARS), lambda x: x["m"])

    kinds = {
        "assign": (text.rlike(ASSIGN), let(matches(text, ASSIGN), assigned)),
        "access": (text.contains("AKIA"), matches(text, ACCESS)),
        "hex": (text.rlike(HEX), matches(text, HEX)),
    }
    each = [F.when(seen, _spans(found, kind)).otherwise(none) for kind, (seen, found) in kinds.items()]
    return F.array_sort(F.concat(*each))


# --- the two Markov models ----------------------------------------------------


def _pairs(samples: DataFrame) -> DataFrame:
    """Character pairs (a, b) and their count over ``samples`` (label, word, n), places in ALPHABET from 1."""
    at = F.transform(F.split("word", ""), lambda c: F.instr(F.lit(ALPHABET), c))
    coded = samples.withColumn("codes", F.filter(at, lambda c: c > 0)).filter(F.size("codes") > 1)
    pair = F.transform(
        F.sequence(F.lit(1), F.size("codes") - 1),
        lambda i: F.struct(F.col("codes")[i - 1].alias("a"), F.col("codes")[i].alias("b")),
    )
    return coded.select("label", "n", F.explode(pair).alias("p")).groupBy("label", "p.a", "p.b").agg(F.sum("n").alias("n"))


def training_samples(docs: DataFrame, text: str = "text", train_documents: int = TRAIN_DOCUMENTS) -> DataFrame:
    """label (random, ordinary), word, n: the labelled samples of the two models.

    Ordinary identifiers are the words of about ``train_documents`` different texts, chosen by a hash of the
    text and read once however many copies there are, that are shorter than a candidate: as written, in
    capitals, and in pairs joined as names are.
    Random strings are SHA-256 values of the same texts in hex and in base 64, and what the base
    patterns find there.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(body.alias("text"))
    total = texts.select(F.xxhash64("text").alias("h")).distinct().count()
    share = min(1.0, train_documents / max(1, total))
    chosen = texts.filter(F.pmod(F.xxhash64("text", F.lit("fit")), F.lit(1 << 20)) < share * (1 << 20)).distinct()
    chosen = materialise(chosen, "secret-samples")
    words = chosen.select(
        F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9]+"), F.lit(0))).alias("word")
    ).filter(F.length("word") < CANDIDATE_CHARS).groupBy("word").agg(F.count("*").alias("n"))
    ordinary = words.select(
        F.lit("ordinary").alias("label"),
        F.explode(
            F.array(
                F.col("word"), F.upper("word"), F.concat("word", F.lit("_"), F.lower("word")),
                F.concat("word", F.lit("-"), F.lower("word")), F.concat("word", F.initcap("word")),
            )
        ).alias("word"),
        "n",
    )
    digest = F.sha2(F.col("text").cast("binary"), 256)
    raw = F.unhex(F.concat(digest, F.sha2(digest.cast("binary"), 256)))
    found = F.transform(base_spans(F.col("text")), lambda s: F.substring("text", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    values = F.transform(found, lambda m: F.regexp_replace(m, r"^.*[^A-Za-z0-9+/_=-]", ""))
    random = chosen.select(
        F.lit("random").alias("label"),
        F.explode(
            F.concat(
                F.array(digest, F.upper(digest), F.base64(raw), F.translate(F.base64(raw), "+/=", "")), values
            )
        ).alias("word"),
        F.lit(1).cast("bigint").alias("n"),
    )
    return ordinary.unionByName(random)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio, random over ordinary, of every pair of characters: a square table by place
    in ALPHABET, first row and column unused. Add-one smoothing; no sample gives a table of zeros."""
    size = len(ALPHABET)
    counts = {"random": {}, "ordinary": {}}
    # at most one row for each label and pair of characters
    for r in _pairs(samples).collect():
        counts[r["label"]][r["a"], r["b"]] = r["n"]

    def log_probability(label: str) -> dict[tuple[int, int], float]:
        own = counts[label]
        totals = [sum(own.get((a, b), 0) for b in range(1, size + 1)) for a in range(size + 1)]
        return {
            (a, b): math.log((own.get((a, b), 0) + 1) / (totals[a] + size))
            for a in range(1, size + 1) for b in range(1, size + 1)
        }

    random, ordinary = log_probability("random"), log_probability("ordinary")
    table = [0.0] * (size + 1) ** 2
    for a, b in random:
        table[a * (size + 1) + b] = round(random[a, b] - ordinary[a, b], 5)
    return table


def ratio(token: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a token, summed over its character pairs."""
    width = len(ALPHABET) + 1
    weights = F.from_json(F.lit(json.dumps(table)), "array<double>")  # folded to one literal
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return let(
        codes,
        lambda c: F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.size(c) - 1, F.lit(1))),
            F.lit(0.0),
            lambda total, i: total + F.coalesce(F.get(weights, F.get(c, i - 1) * width + F.get(c, i)), F.lit(0.0)),
        ),
    )


def _apart(candidate: Column, base: Column) -> Column:
    """The parts of a candidate outside the base spans (by start) that are candidates themselves."""
    touching = F.filter(base, lambda s: (s["start"] < candidate["end"]) & (candidate["start"] < s["end"]))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    first = F.struct(candidate["start"].alias("at"), none.alias("out"))

    def grown(out: Column, start: Column, end: Column) -> Column:
        part = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.when(end - start >= CANDIDATE_CHARS, F.concat(out, part)).otherwise(out)

    def add(state: Column, span: Column) -> Column:
        at = F.greatest(state["at"], span["end"])
        return F.struct(at.alias("at"), grown(state["out"], state["at"], span["start"]).alias("out"))

    def named(part: Column) -> Column:
        begin, size = part["start"] - candidate["start"] + 1, part["end"] - part["start"]
        text = F.substring(candidate["text"], begin.cast("int"), size.cast("int"))
        text = F.regexp_replace(text, "^[^A-Za-z0-9]+", "")  # a candidate begins with a letter or digit
        return F.struct((part["end"] - F.length(text)).alias("start"), part["end"].alias("end"), text.alias("text"))

    parts = F.aggregate(touching, first, add, lambda state: grown(state["out"], state["at"], candidate["end"]))
    return F.filter(F.transform(parts, named), lambda m: F.length(m["text"]) >= CANDIDATE_CHARS)


def markov_spans(text: Column, base: Column, table: list[float]) -> Column:
    """Candidates whose ratio reaches RATIO; one that touches base spans is cut there, and what remains of
    it on either side is scored by itself."""

    def likely(base_set: Column) -> Column:
        parts = F.flatten(F.transform(matches(text, CANDIDATE), lambda m: _apart(m, base_set)))
        return F.filter(parts, lambda m: ratio(m["text"], table) >= RATIO)

    found = F.when(text.rlike(CANDIDATE), _spans(let(base, likely), MARKOV))
    return found.otherwise(F.array().cast(_SPANS))


# --- operators ----------------------------------------------------------------


def scan(docs: DataFrame, table: list[float], text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, rank, end, kind) in code points, end exclusive,
    ordered by start, then kind (assign, access, hex, markov); ``spans`` holds the base spans too.

    A null text counts as empty and has none. A projection: rows, repeats included, stay as they are;
    other columns are kept, those named like a result replaced.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = docs.withColumn("base", base_spans(whole))
    more = markov_spans(whole, F.col("base"), table)
    return found.withColumn("spans", F.array_sort(F.concat("base", more)))


def redact(scanned: DataFrame, text: str = "text") -> DataFrame:
    """``scanned`` with every span of ``text`` replaced by REDACTED; spans that overlap become one."""
    body = F.col(text)
    first = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(None).cast("binary").alias("text"))
    mark = F.encode(F.lit(REDACTED), "UTF-32")

    def rewrite(points: Column) -> Column:
        # four bytes for each code point, so that a slice costs what it holds
        def add(state: Column, span: Column) -> Column:
            gap = F.substring(points, (state["at"] * 4 + 1).cast("int"), F.greatest((span["start"] - state["at"]) * 4, F.lit(0)).cast("int"))
            apart = (span["start"] >= state["at"]) | state["text"].isNull()
            joined = F.concat(F.coalesce(state["text"], F.unhex(F.lit(""))), gap, mark)
            return F.struct(
                F.greatest(state["at"], span["end"]).alias("at"),
                F.when(apart, joined).otherwise(state["text"]).alias("text"),
            )

        def finish(state: Column) -> Column:
            rest = F.substring(points, (state["at"] * 4 + 1).cast("int"), F.octet_length(points))
            # decoding takes away one byte-order mark, so one is put before the text
            return F.decode(F.concat(F.unhex(F.lit("0000FEFF")), state["text"], rest), "UTF-32")

        return F.aggregate("spans", first, add, finish)

    hidden = let(F.encode(body, "UTF-32"), rewrite)
    return scanned.withColumn(text, F.when(F.size("spans") > 0, hidden).otherwise(body))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    each = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(each, ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
