"""Encoding of the whole corpus with a public byte-level BPE vocabulary, and back.

Pre-tokens are cut once in the JVM with the vocabulary's own pattern. A task packs its documents into blocks of about
``BLOCK_WORDS`` pre-tokens and numbers the distinct words of each: a document becomes the list of its words' numbers in
order of position, and of every word only one row per block goes on. These words are exploded and shuffled once:
every distinct word of the corpus is encoded once, its ids are joined back to the blocks, and each block reassembles its
documents by position with array operations. A word of which a third of the corpus consists has still but one row per
block. The vocabulary file has a fixed size and is broadcast; its path is a parameter.

Texts with characters that the JVM's Unicode tables do not know yet are cut in Python with newer tables, all others in
the JVM.

Defined results: null and empty texts have the empty list of ids; strings of special tokens are ordinary text; repeated
rows count once; a doc_id with several texts has a row for each; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.runtime import cut, spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_WORDS = 300_000
MAX_VOCABULARY = 1_000_000

_built: dict[int, object] = {}


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}


def _encoder(content: bytes):
    import tiktoken

    key = hash(content)
    if key not in _built:
        _built[key] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks(content), special_tokens={})
    return _built[key]


def _pieces_in_python(texts: pd.Series) -> pd.Series:
    import regex

    cutter = regex.compile(PATTERN)
    return texts.map(cutter.findall)


def pieces(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``h`` (hash of the text), ``words`` (the pre-tokens in order)."""
    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("h")).filter("text is not null and text <> ''")
    newer = F.col("text").rlike(r"\p{Cn}")
    in_python = F.pandas_udf(_pieces_in_python, "array<string>")
    native = rows.filter(~newer).select("doc_id", "h", F.regexp_extract_all("text", F.lit("(?U)" + PATTERN), F.lit(0)).alias("words"))
    other = rows.filter(newer).select("doc_id", "h", in_python("text").alias("words"))
    return native.union(other)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as numbers of their block's words, and per block one row with the words by number."""
    task, made, waiting, size = TaskContext.get().partitionId(), 0, [], 0

    def pack() -> Iterator[pa.RecordBatch]:
        docs = pa.Table.from_batches(waiting).combine_chunks()
        n = len(docs)
        words = docs["words"].chunk(0)
        flat = words.flatten().dictionary_encode()
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))]).astype(np.int32)
        block = (task << 32) + made
        columns = [np.full(n, block), docs["doc_id"].chunk(0), docs["h"].chunk(0), np.arange(n), pa.ListArray.from_arrays(ends, flat.indices), pa.nulls(n, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=_BLOCK_NAMES)
        listed = pa.ListArray.from_arrays(np.array([0, len(flat.dictionary)], dtype=np.int32), flat.dictionary)
        none = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([block]), none, none, none, pa.nulls(1, pa.list_(pa.int32())), listed], names=_BLOCK_NAMES)

    for batch in batches:
        if len(batch):
            waiting.append(batch)
            size += len(batch["words"].flatten())
        if size >= BLOCK_WORDS:
            yield from pack()
            made, waiting, size = made + 1, [], 0
    if waiting:
        yield from pack()


_BLOCK_NAMES = ["block", "doc_id", "h", "at", "numbers", "words"]
_BLOCK_SCHEMA = "block bigint, doc_id bigint, h bigint, at bigint, numbers array<int>, words array<string>"


def _assembled(docs: pa.Table, words: pa.Table) -> pa.Table:
    """The ids of a block's documents, by position."""
    number = words["number"].to_numpy()
    ids = words["ids"].combine_chunks()
    length = np.zeros(len(number), dtype=np.int64)
    length[number] = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
    start = np.zeros(len(number), dtype=np.int64)
    start[number] = np.concatenate([[0], np.cumsum(length[number])[:-1]]) if len(number) else []
    lists = docs["numbers"].combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    many = length[flat]
    upto = np.concatenate([[0], np.cumsum(many)])
    take = np.repeat(start[flat] - upto[:-1], many) + np.arange(upto[-1])
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    out = pa.ListArray.from_arrays(upto[ends].astype(np.int32), ids.flatten().take(pa.array(take)))
    return pa.table({"doc_id": docs["doc_id"], "ids": out})


def dictionary(words: DataFrame, content: bytes) -> DataFrame:
    """Every distinct ``word`` with its ``ids``."""
    shared = words.sparkSession.sparkContext.broadcast(content)

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = _encoder(shared.value).encode_ordinary  # a pre-token on its own is cut no further
        for frame in frames:
            yield pd.DataFrame({"word": frame["word"], "ids": [one(w) for w in frame["word"]]})

    return words.select("word").distinct().mapInPandas(encode, "word string, ids array<int>")


def encode(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id``, ``ids`` of each document."""
    blocks = cut(pieces(spread(documents.select("doc_id", "text"))).mapInArrow(_blocks, _BLOCK_SCHEMA))
    docs = blocks.filter("words is null").select("block", "doc_id", "h", "at", "numbers")
    words = blocks.filter("words is not null").select(F.col("block").alias("of"), F.posexplode("words").alias("number", "word"))
    # repeated rows: all but the first of each text of a document
    same = docs.groupBy("doc_id", "h").agg(F.min(F.struct("block", "at")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    if same.limit(1).count():
        first = F.struct(docs["block"], docs["at"])
        docs = docs.join(same, docs["doc_id"].eqNullSafe(same["doc_id"]) & (docs["h"] == same["h"]) & (first != same["first"]), "left_anti")
    known = words.join(dictionary(words, read_vocabulary(vocabulary)), "word").select("of", "number", "ids")
    full = docs.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_assembled, "doc_id bigint, ids array<int>")
    empty = documents.filter("text is null or text = ''").select("doc_id", F.array().cast("array<int>").alias("ids")).distinct()
    return full.union(empty)


def token_bytes(spark: SparkSession, vocabulary: str = VOCABULARY) -> DataFrame:
    """``id``, ``hex``: the bytes of each token, one row per vocabulary entry."""
    table = ranks(read_vocabulary(vocabulary))
    if len(table) > MAX_VOCABULARY:
        raise ValueError("the vocabulary is too large to broadcast")
    return spark.createDataFrame(pd.DataFrame({"id": list(table.values()), "hex": [b.hex() for b in table]}), "id int, hex string")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id``, ``text`` from ``doc_id``, ``ids``; the empty list gives the empty text."""
    known = F.broadcast(token_bytes(encoded.sparkSession, vocabulary))
    rows = encoded.select("doc_id", F.xxhash64("ids").alias("h"), F.posexplode_outer("ids").alias("pos", "id")).join(known, "id", "left")
    gathered = rows.groupBy("doc_id", "h").agg(F.sort_array(F.collect_set(F.struct("pos", F.coalesce("hex", F.lit("")).alias("hex")))).alias("a"))
    return gathered.select("doc_id", F.decode(F.unhex(F.array_join(F.transform("a", lambda x: x["hex"]), "")), "UTF-8").alias("text"))
