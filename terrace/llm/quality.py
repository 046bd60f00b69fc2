"""Per-document text quality statistics, and what they say about the kind of text.

Texts are cut into segments: paragraphs, and within these runs of about ``SEGMENT`` words (a short rest joins the run
before it). Thresholds on a segment's statistics are noisy labelling functions, each voting prose, no prose or
nothing. Expectation-maximisation on the counts of all vote patterns learns how often each function is right, without
labels: first for prose against the rest, then within the rest for lists, tables and junk. Every pattern thus has a
posterior of four types, and a document that of its segments, weighted by their characters. A document is no prose if
more than half of its non-blank characters lie in segments that are not.

All statistics are built-in expressions in one pass over whole texts. There are at most 3^n patterns of n functions,
whatever the corpus; only their counts reach the driver and only their posteriors are broadcast. What is learnt is a
``Model``: it can be kept as text and given to ``statistics``, so that a document's type does not depend on the corpus
it comes with.

Lines are those of the whole text, the last one included; a line is closed if it ends in a full stop, question or
exclamation mark or ellipsis, quotes and brackets after it aside.

Defined results: null, empty and blank texts have null shares, the type ``empty`` and are never found; repeated rows
count once; a doc_id with several texts has a row for each; languages are compared in lower case, unknown and missing
ones are judged by the language that fits best; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.text import WHITE_SPACE
from terrace.runtime import cut, spread

SEGMENT, REST = 30, 9
MAX_COMMON_WORDS = 100_000
BREAK = "␤"
ROUNDS = 60
STOPS, CLOSERS = (".", "!", "?", "…", "。"), "\"'”’»)]"

TYPES = ("prose", "list", "table", "junk")
VOTES = ("common", "distinct_common", "gap", "symbols", "digits", "lower", "length", "marks", "lines", "repeats")


def common_words(table: DataFrame) -> dict[str, list[str]]:
    """The frequent words by language, composed and decomposed. A fixed table; its size is checked."""
    rows = table.filter("word is not null and lang is not null").select("lang", "word").distinct().limit(MAX_COMMON_WORDS + 1).collect()
    if len(rows) > MAX_COMMON_WORDS:
        raise ValueError(f"more than {MAX_COMMON_WORDS} common words")
    out: dict[str, set[str]] = {}
    for r in rows:
        word = r["word"].lower()
        out.setdefault(r["lang"].lower(), set()).update((word, unicodedata.normalize("NFC", word), unicodedata.normalize("NFD", word)))
    return {lang: sorted(words) for lang, words in sorted(out.items())}


def _count(array: Column, test) -> Column:
    return F.size(F.filter(array, test))


def _among(words: list[str]):
    return lambda x: x.isin(words)


def plain_text(text: Column) -> Column:
    """Full-width letters narrowed, soft hyphens and zero-width spaces dropped, line ends as line feeds, all other white
    space as blanks, none of it in front. Most texts hold nothing of the kind and are only looked through."""
    wide, narrow = "".join(chr(c) for c in range(0xFF01, 0xFF5F)), "".join(chr(c) for c in range(0x21, 0x7F))
    space = "".join(c for c in WHITE_SPACE if c not in " \n\r\x85\u2028\u2029")
    odd = r"[\u00ad\u200b\uff01-\uff5e\t\x0b\f\r\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
    mapped = F.translate(text, wide + space + "\u00ad\u200b", narrow + " " * len(space))
    return F.ltrim(F.when(text.rlike(odd), F.regexp_replace(mapped, r"\r\n?|[\u2028\u2029\u0085]", "\n")).otherwise(text), F.lit(" \n"))


def segments(documents: DataFrame, common: dict[str, list[str]]) -> DataFrame:
    """One row per segment with its statistics."""
    text = plain_text(F.col("text"))
    piece = rf"[^ ]++(?: ++[^ ]++){{0,{SEGMENT - 1}}}+(?:(?: ++[^ ]++){{1,{REST}}}+ *+\z)?+"
    rows = documents.filter("text is not null").select("doc_id", F.lower("lang").alias("lang"), F.xxhash64("text").alias("h"), text.alias("text"))
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.btrim(x)), lambda x: x != "")
    rows = rows.withColumn("lines", lines)
    closed = _count(F.col("lines"), lambda x: F.substring(F.rtrim(x, F.lit(CLOSERS)), -1, 1).isin(*STOPS))
    rows = rows.select("doc_id", "lang", F.struct("h", F.struct(F.size("lines").alias("all"), closed.alias("closed")).alias("lines")).alias("h"), "text")
    parts = rows.select("doc_id", "lang", "h", F.posexplode(F.split("text", r"\n[ \n]*\n")).alias("at", "part"))
    cut_ = parts.select("doc_id", "lang", "h", "at", F.posexplode(F.regexp_extract_all(F.replace("part", F.lit("\n"), F.lit(f" {BREAK} ")), F.lit(piece), F.lit(0))).alias("in_part", "seg"))
    tokens = F.filter(F.split("seg", " "), lambda x: (x != "") & (x != BREAK))
    bare = F.transform("tok", lambda x: F.regexp_replace(F.lower(x), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+\z", ""))
    first = ((F.col("at") == 0) & (F.col("in_part") == 0)).cast("int").alias("first")  # one for each row, repeated ones too
    every = sorted({w for ws in common.values() for w in ws}) or [""]
    s = cut_.select("doc_id", "lang", "h", first, "seg", tokens.alias("tok")).filter(F.size("tok") > 0).withColumn("bare", bare)
    s = s.withColumn("hits", F.filter("bare", lambda x: x.isin(every)))
    plain = F.replace("seg", F.lit(BREAK), F.lit(""))
    chars = lambda pattern: F.char_length(F.regexp_replace(plain, pattern, ""))
    n = F.size("tok")
    s = s.select(
        "doc_id", "lang", F.col("h.h").alias("h"), "h.lines", "first",
        n.alias("n"),
        F.char_length(F.replace(plain, F.lit(" "), F.lit(""))).alias("chars"),
        chars(r"[^\p{L}]+").alias("letters"),
        chars(r"[^\p{N}]+").alias("digits"),
        F.regexp_count("seg", F.lit(BREAK)).alias("breaks"),
        F.array(*[_count(F.col("hits"), _among(ws)) for ws in common.values()] or [F.lit(0)]).alias("by_lang"),
        F.array_join(F.transform("bare", lambda x: F.when(x.isin(every), "1").otherwise("0")), "").alias("flags"),
        F.size(F.array_distinct("hits")).alias("common_kinds"),
        _count(F.col("tok"), lambda x: x.rlike(r"^[^\p{L}]*\p{Ll}")).alias("low"),
        _count(F.col("tok"), lambda x: x.rlike(r"^[^\p{L}]*\p{Lu}\p{Ll}")).alias("title"),
        _count(F.col("tok"), lambda x: x.rlike(r"[=|{}<>\[\]\\/_·»•*~^#+@]|^[-–—]+\z|;.|:\d|\d[).]\z")).alias("marked"),
        F.size(F.array_distinct("bare")).alias("kinds"),
    )
    return s


def votes(seg: DataFrame) -> DataFrame:
    """Segments with ``pattern``: one digit per labelling function, 1 prose, 2 no prose, 0 nothing."""
    n, chars = F.col("n"), F.greatest(F.col("chars"), F.lit(1))
    share = F.array_max("by_lang") / n
    symbols = (F.col("chars") - F.col("letters") - F.col("digits")) / chars
    vote = lambda yes, no: F.when(yes, "1").when(no, "2").otherwise("0")
    lower = F.col("low") / F.greatest(F.col("low") + F.col("title"), F.lit(1))
    rules = {
        "common": vote(share >= 0.2, share <= 0.12),
        "distinct_common": vote(F.col("common_kinds") >= F.least(F.lit(4), F.ceil(n / 6)), F.col("common_kinds") <= F.floor(n / 12)),
        "gap": vote(~F.col("flags").rlike("0{8}"), F.col("flags").rlike("0{12}")),
        "symbols": vote(symbols <= 0.08, symbols >= 0.15),
        "digits": vote(F.lit(False), F.col("digits") / chars >= 0.25),
        "lower": F.when(F.col("low") + F.col("title") < 4, "0").otherwise(vote(lower >= 0.6, lower <= 0.3)),
        "length": vote((F.col("chars") / n).between(3, 7.5), F.col("chars") / n > 11),
        "marks": vote(F.col("marked") / n <= 0.05, F.col("marked") / n >= 0.2),
        "lines": vote(F.col("breaks") / n <= 0.13, F.col("breaks") / n >= 0.2),
        "repeats": F.when(n < 8, "0").otherwise(vote(F.col("kinds") / n >= 0.7, F.col("kinds") / n <= 0.5)),
    }
    assert tuple(rules) == VOTES
    return seg.withColumn("pattern", F.concat(*rules.values()))


def _one_hot(patterns: list[str]) -> tuple[np.ndarray, np.ndarray]:
    v = np.array([[int(c) for c in p] for p in patterns], dtype=int).reshape(len(patterns), len(VOTES))
    return v, np.stack([(v == k) for k in range(3)], axis=2).astype(float)


def _posterior(one: np.ndarray, prior: np.ndarray, vote: np.ndarray) -> np.ndarray:
    logs = np.log(prior)[None, :] + np.einsum("ijk,cjk->ic", one, np.log(vote))
    logs -= logs.max(axis=1, keepdims=True)
    p = np.exp(logs)
    return p / p.sum(axis=1, keepdims=True)


def _maximise(one: np.ndarray, p: np.ndarray, counts: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the classes and, for each, how often each function gives each vote. Votes are taken as independent
    given the class; counts of one are added throughout, so nothing becomes certain."""
    for _ in range(rounds):
        mass = (p * counts[:, None]).sum(axis=0)
        prior = (mass + 1) / (mass.sum() + p.shape[1])
        vote = np.einsum("ic,ijk->cjk", p * counts[:, None], one) + 1
        vote /= vote.sum(axis=2, keepdims=True)
        p = _posterior(one, prior, vote)
    return prior, vote


@dataclass
class Model:
    """What was learnt: shares and vote probabilities of (prose, rest) and of (list, table, junk) within the rest."""

    prior: np.ndarray
    vote: np.ndarray
    kind_prior: np.ndarray
    kind_vote: np.ndarray

    def posterior(self, patterns: list[str]) -> np.ndarray:
        """One row per pattern, one column per type of ``TYPES``."""
        one = _one_hot(patterns)[1]
        first, kinds = _posterior(one, self.prior, self.vote), _posterior(one, self.kind_prior, self.kind_vote)
        return np.hstack([first[:, :1], first[:, 1:] * kinds])

    def to_json(self) -> str:
        return json.dumps({k: v.tolist() for k, v in vars(self).items()})

    @staticmethod
    def from_json(text: str) -> Model:
        return Model(**{k: np.array(v) for k, v in json.loads(text).items()})


def learn(patterns: list[str], counts: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation from the counts of vote patterns. The first guess of prose is the majority of the votes
    cast, that of the other types the votes that speak of each."""
    v, one = _one_hot(patterns)
    lead = (v == 1).sum(1) - (v == 2).sum(1) + 0.5 * ((v[:, 0] == 1).astype(int) - (v[:, 0] == 2).astype(int))
    p = 1 / (1 + np.exp(-lead.astype(float)))
    prior, vote = _maximise(one, np.column_stack([p, 1 - p]), counts, rounds)
    no = _posterior(one, prior, vote)[:, 1]
    against = lambda *names: sum(v[:, VOTES.index(n)] == 2 for n in names).astype(float)
    hints = np.column_stack([against("lines", "lower", "gap") + 0.5, against("marks", "symbols", "digits") + 0.5, against("repeats", "length", "distinct_common") + 0.5])
    kind_prior, kind_vote = _maximise(one, hints / hints.sum(axis=1, keepdims=True), counts * no, rounds)
    return Model(prior, vote, kind_prior, kind_vote)


def _judged(documents: DataFrame, common: dict[str, list[str]], model: Model | None) -> tuple[DataFrame, Model | None]:
    """Segments with the posterior of each type, and the model, learnt from these documents if none is given."""
    spark = documents.sparkSession
    seg = cut(votes(segments(spread(documents.select("doc_id", "lang", "text")), common)).drop("flags", "low", "title", "kinds", "marked", "common_kinds", "breaks"))
    seen = seg.groupBy("pattern").agg(F.count("*").alias("n")).toPandas().sort_values("pattern")
    patterns = [str(x) for x in seen["pattern"]]
    model = model or (learn(patterns, seen["n"].to_numpy(dtype=float)) if patterns else None)
    share = model.posterior(patterns) if patterns else np.zeros((0, len(TYPES)))
    known = spark.createDataFrame(pd.DataFrame({"pattern": pd.Series(patterns, dtype=object), **{t: share[:, k] for k, t in enumerate(TYPES)}}), "pattern string, " + ", ".join(f"{t} double" for t in TYPES))
    return seg.join(F.broadcast(known), "pattern"), model


def fit(documents: DataFrame, words: DataFrame) -> Model | None:
    """The model of a corpus, None if it holds no words."""
    return _judged(documents, common_words(words), None)[1]


def statistics(documents: DataFrame, words: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, words, mean_word_length, symbol_ratio, closed_lines, common_share, prose_share, the posterior of each type
    (p_prose, p_list, p_table, p_junk), text_type."""
    common = common_words(words)
    judged, _ = _judged(documents, common, model)
    total = F.sum
    counts = [total(F.col("by_lang")[i]) for i in range(len(common))]
    mine = F.coalesce(*[F.when(F.col("lang") == lang, F.col("common")[i]) for i, lang in enumerate(common)], F.array_max("common")) if common else F.lit(0)
    by_doc = judged.groupBy("doc_id", "h").agg(
        total("n").alias("all_words"), F.greatest(total("first"), F.lit(1)).alias("copies"), F.max("lang").alias("lang"), total("chars").alias("chars"), total("letters").alias("letters"),
        total("digits").alias("digits"), F.max("lines.all").alias("lines"), F.max("lines.closed").alias("closed"), (F.array(*counts) if counts else F.array(F.lit(0))).alias("common"),
        total(F.when(F.col("prose") >= 0.5, F.col("chars")).otherwise(0)).alias("prose_chars"), *[total(F.col(t) * F.col("chars")).alias(f"_{t}") for t in TYPES],
    )
    posterior = [(F.col(f"_{t}") / F.col("chars")).alias(f"p_{t}") for t in TYPES]
    rest = F.greatest(*[F.col(f"_{t}") for t in TYPES[1:]])
    kind = F.when(F.col("prose_chars") * 2 >= F.col("chars"), "prose")
    for t in TYPES[1:]:
        kind = kind.when(F.col(f"_{t}") == rest, t)
    found = by_doc.select(
        "doc_id", F.floor(F.col("all_words") / F.col("copies")).cast("bigint").alias("words"), (F.col("chars") / F.col("all_words")).alias("mean_word_length"),
        ((F.col("chars") - F.col("letters") - F.col("digits")) / F.col("chars")).alias("symbol_ratio"), (F.col("closed") / F.col("lines")).alias("closed_lines"),
        (mine / F.col("all_words")).alias("common_share"), (F.col("prose_chars") / F.col("chars")).alias("prose_share"), *posterior, kind.alias("text_type"),
    )
    blank = documents.filter(F.col("text").isNull() | ~F.col("text").rlike(r"(?U)\S")).select("doc_id").distinct()
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    shares = ("mean_word_length", "symbol_ratio", "closed_lines", "common_share", "prose_share", *[f"p_{t}" for t in TYPES])
    empty = blank.select("doc_id", F.lit(0).cast("bigint").alias("words"), *[none(c, "double") for c in shares], F.lit("empty").alias("text_type"))
    return found.union(empty)
