"""Evaluation texts leaking into training text.

Latent semantic retrieval. Evaluation texts are cut into passages, weighted by TF-IDF with document frequencies of the
whole corpus, and a randomised SVD (range finding with power iterations, its products summed over tasks) gives the
latent space.

Verbatim leaks: a shared run of ``RUN`` words (all words, if the item has fewer). Every window of just that many words,
at step 1, is projected on one direction of the latent space in whole numbers; a run has the very value of the item's
own window, so no threshold is needed, and windows of equal value are compared word by word. The cosine reported is
that of the best window around the run, however low.

Paraphrases of single passages: every name and number of the passage (its answers; the rarest words, if it has none)
must occur near by. A window is therefore only searched for passages whose rarest answer word it holds, which loses
nothing. Windows whose cosine to such a passage reaches ``PARAPHRASE_COSINE`` are candidates; all answers and a common
subsequence of ``PARAPHRASE_SHARE`` of the passage in the words around decide.

The corpus is cut into words once, as 64-bit hashes (two words of a corpus of 10^9 different ones share the hash of one
of 10^5 evaluation words with a chance of 1 in 10^5; a false run needs ten such words in a row). It is then read twice,
however many items there are: once for document frequencies, once for the search, in which each task takes the blocks
of items in turn. Items are packed into blocks of ``BLOCK_WORDS`` words (a longer item is a block of its own), which
bounds what is broadcast at a time. Documents are never joined with each other and nothing of the corpus but word counts
reaches the driver.

Defined results: null, empty and wordless texts match nothing; repeated documents or items count once per id; an item
of n < 10 words needs all its words in order; equal items are reported each; empty tables give empty results.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.runtime import cut_counting, spread

RUN = 10
PASSAGE, STEP = 15, 5
RANK = 256
POWER = 2
PARAPHRASE_COSINE = 0.6
PARAPHRASE_SHARE = 0.7
ANSWER_WORDS = 3
BLOCK_WORDS = 40_000
TASK_WORDS, TASK_DOCS = 2_000_000, 5_000
CHUNK_WORDS = 500_000
TASK_TRIPLES = 50_000
MEMO_WORDS = 1_000_000
SEED = 8

#: Runs of characters of the categories L and N; the test on all code points finds no other.
WORD = re.compile(r"[^\W_]+")
_memo: dict[str, int] = {}


def _plain(text: str) -> str:
    return unicodedata.normalize("NFKC", text)


def words(text: str | None) -> list[str]:
    """NFKC, lower case, without soft hyphens and zero-width spaces, cut into runs of letters and digits."""
    return WORD.findall(_plain(text).lower().replace("­", "").replace("​", "")) if text else []


def _hash(word: str) -> int:
    import xxhash

    if len(_memo) >= MEMO_WORDS:
        _memo.clear()
    _memo[word] = code = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) - (1 << 63)
    return code


def word_codes(ws: list[str]) -> np.ndarray:
    got = map(_memo.get, ws)
    return np.array([_hash(w) if c is None else c for c, w in zip(got, ws)], dtype=np.int64)


def answers(text: str) -> list[tuple[int, int]]:
    """Spans (first word, word behind the last) of names and numbers: words with digits, and words in capitals that do
    not begin a sentence."""
    plain = _plain(text).replace("­", "").replace("​", "")
    found = list(WORD.finditer(plain))
    if [m.group().lower() for m in found] != words(text):
        return []
    marked, end = [], 0
    for m in found:
        gap = plain[end : m.start()]
        begins = end == 0 or any(c in ".!?…:\n" for c in gap)
        marked.append(any(c.isdigit() for c in m.group()) or (m.group()[0].isupper() and not begins))
        end = m.end()
    spans, start = [], None
    for k, is_ in enumerate([*marked, False]):
        if is_ and start is None:
            start = k
        elif not is_ and start is not None:
            spans.append((start, k))
            start = None
    return spans


def _starts(n: int, size: int, step: int) -> np.ndarray:
    at = np.arange(0, max(1, n - size + 1), step)
    return at if n <= size or at[-1] + size >= n else np.append(at, n - size)


@dataclass
class Block:
    """Evaluation items as numbers of the block's own vocabulary (``hashes``, ascending), their passages and runs."""

    ids: list[int]
    codes: list[np.ndarray]
    hashes: np.ndarray
    owner: np.ndarray
    start: np.ndarray
    spans: list[list[tuple[int, int]]]
    rows: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), dtype=np.float32))
    latent: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), dtype=np.float32))
    needed: list[list[np.ndarray]] = field(default_factory=list)
    anchored: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    of_item: list[list[int]] = field(default_factory=list)
    steps: list[int] = field(default_factory=list)
    spare: list[int] = field(default_factory=list)
    answer_words: list[frozenset[int]] = field(default_factory=list)
    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)
    value: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))

    @staticmethod
    def of(rows: list[tuple[int, str, list[str]]]) -> Block:
        raw = [word_codes(ws) for _, _, ws in rows]
        hashes = np.unique(np.concatenate(raw))
        codes = [np.searchsorted(hashes, c).astype(np.int32) for c in raw]
        at = [(k, int(s)) for k, c in enumerate(codes) for s in _starts(len(c), PASSAGE, STEP)]
        return Block([i for i, _, _ in rows], codes, hashes, np.array([k for k, _ in at]), np.array([s for _, s in at]), [answers(t) for _, t, _ in rows])

    def run_length(self, k: int) -> int:
        return min(RUN, len(self.codes[k]))

    def step(self, p: int) -> int:
        """Windows are twice as long: 20 words at steps of 10, for the very short items as many as they need."""
        n = self.run_length(self.owner[p])
        return RUN if n >= 6 else n

    def passage(self, p: int) -> np.ndarray:
        return self.codes[self.owner[p]][self.start[p] : self.start[p] + PASSAGE]

    def triples(self, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The TF-IDF matrix of the passages, rows of length 1, as (passage, word, weight), ordered by passage."""
        parts = [np.unique(self.passage(p), return_counts=True) for p in range(len(self.owner))]
        row = np.repeat(np.arange(len(parts)), [len(w) for w, _ in parts])
        col = np.concatenate([w for w, _ in parts]).astype(np.int64)
        weight = np.concatenate([n for _, n in parts]) * idf[col]
        length = np.sqrt(np.bincount(row, weight**2))
        return row, col, (weight / length[row]).astype(np.float32)

    def finish(self, idf: np.ndarray, space: np.ndarray, triples: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        row, col, weight = triples
        first = np.searchsorted(row, np.arange(len(self.owner)))
        latent = np.vstack([np.add.reduceat(weight[a:b, None] * space[col[a:b]], first[lo : lo + 1024] - a, axis=0) for lo, a, b in self._slices(first, len(row))])
        self.latent = latent / (np.linalg.norm(latent, axis=1, keepdims=True) + 1e-12)
        self.rows = np.vstack([idf[:, None] * space, np.zeros((1, space.shape[1]), dtype=np.float32)]).astype(np.float32)
        self.of_item = [[] for _ in self.ids]
        self.steps = [self.step(p) for p in range(len(self.owner))]
        self.spare = [max(0, 2 * self.steps[p] - len(self.passage(p))) // 2 for p in range(len(self.owner))]
        for p, k in enumerate(self.owner):
            self.of_item[k].append(p)
            s, codes = int(self.start[p]), self.passage(p)
            mine = [codes[a - s : b - s] for a, b in self.spans[k] if s <= a and b <= s + len(codes)]
            if not mine:
                mine = [codes[i : i + 1] for i in np.argsort(-idf[codes], kind="stable")[:ANSWER_WORDS]]
            rarest = max((int(c) for span in mine for c in span), key=lambda c: (idf[c], -c))
            self.needed.append(mine)
            self.answer_words.append(frozenset(int(c) for span in mine for c in span))
            self.anchored.setdefault(rarest, []).extend((p, int(at)) for at in np.flatnonzero(codes == rarest))
        direction = np.random.default_rng(SEED).standard_normal(space.shape[1])
        self.value = np.rint(self.rows.astype(np.float64) @ direction * 2.0**32).astype(np.int64)
        by_length = defaultdict(list)
        for k, codes in enumerate(self.codes):
            n = self.run_length(k)
            sums = np.concatenate([[0], np.cumsum(self.value[codes])])
            by_length[n].append((sums[n:] - sums[:-n], np.full(len(codes) - n + 1, k), np.arange(len(codes) - n + 1)))
        for n, parts in by_length.items():
            value, item, at = (np.concatenate([x[j] for x in parts]) for j in range(3))
            order = np.argsort(value, kind="stable")
            self.runs[n] = (value[order], item[order], at[order])

    @staticmethod
    def _slices(first: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
        for lo in range(0, len(first), 1024):
            yield lo, int(first[lo]), int(first[lo + 1024]) if lo + 1024 < len(first) else n

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        """Word hashes as numbers of the vocabulary, -1 for others."""
        at = np.minimum(np.searchsorted(self.hashes, codes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == codes, at, -1)

    def found(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(where, item) of every run that ``codes`` holds; -1 parts documents. Sums wrap round on both sides alike."""
        sums = np.concatenate([[0], np.cumsum(self.value[codes])])
        inside = np.concatenate([[0], np.cumsum(codes >= 0)])
        for n, (values, item, at) in self.runs.items():
            there = np.flatnonzero(inside[n:] - inside[:-n] == n) if len(codes) >= n else np.zeros(0, dtype=np.int64)
            mine = sums[there + n] - sums[there]
            low, high = np.searchsorted(values, mine, "left"), np.searchsorted(values, mine, "right")
            for i in np.flatnonzero(high > low):
                run = codes[there[i] : there[i] + n]
                for j in range(low[i], high[i]):
                    if np.array_equal(self.codes[item[j]][at[j] : at[j] + n], run):
                        yield int(there[i]), int(item[j])


def randomised_svd(triples: DataFrame, columns: int, rank: int = RANK, power: int = POWER, seed: int = SEED) -> np.ndarray:
    """Right singular vectors (columns x rank) of the sparse matrix ``triples`` (row, col, weight).

    The products A' (A X) run over tasks that hold whole rows of A, as many as the size of A asks for; their sums are
    added up by column in a second stage, and only columns x rank numbers reach the driver.
    """
    spark = triples.sparkSession
    rank = min(rank, columns)
    width = min(columns, rank + 16)
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((columns, width)).astype(np.float32)
    tasks = max(1, -(-triples.count() // TASK_TRIPLES))

    def gram(x: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(x)

        def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            frame = pd.concat(list(frames) or [pd.DataFrame({"row": [], "col": [], "weight": []})])
            if len(frame):
                y = shared.value
                row = np.unique(frame["row"].to_numpy(), return_inverse=True)[1]
                used, col = np.unique(frame["col"].to_numpy(dtype=np.int64), return_inverse=True)
                weight = frame["weight"].to_numpy(dtype=np.float32)
                ay, total = np.zeros((row.max() + 1, width), dtype=np.float32), np.zeros((len(used), width), dtype=np.float64)
                np.add.at(ay, row, weight[:, None] * y[used[col]])
                np.add.at(total, col, weight[:, None] * ay[row])
                yield pd.DataFrame({"col": used, "v": [v.tobytes() for v in total.astype(np.float32)]})

        def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums: dict[int, np.ndarray] = {}
            for frame in frames:
                for c, v in zip(frame["col"], frame["v"]):
                    one = np.frombuffer(v, dtype=np.float32)
                    sums[c] = sums[c] + one if c in sums else one.astype(np.float64)
            yield pd.DataFrame({"col": list(sums), "v": [v.astype(np.float32).tobytes() for v in sums.values()]})

        sums = triples.repartition(tasks, "row").mapInPandas(part, "col bigint, v binary")
        if tasks > 1:
            sums = sums.repartition(tasks, "col").mapInPandas(add, "col bigint, v binary")
        total = np.zeros((columns, width))
        for r in sums.collect():
            total[r["col"]] += np.frombuffer(r["v"], dtype=np.float32)
        shared.unpersist()
        return total

    y = gram(base)
    for _ in range(power):
        y = gram(np.linalg.qr(y)[0].astype(np.float32))
    q = np.linalg.qr(y)[0]
    small = q.T @ gram(q.astype(np.float32))
    _, vectors = np.linalg.eigh((small + small.T) / 2)
    return (q @ vectors[:, ::-1][:, :rank]).astype(np.float32)


def coded(documents: DataFrame) -> tuple[DataFrame, int, int]:
    """``doc_id``, ``codes`` of each document with words, and how many documents and words there are."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "codes": [word_codes(words(t)) for t in frame["text"]]})

    rows = spread(documents.filter("doc_id is not null and text is not null").select("doc_id", "text"))
    out, seen = cut_counting(rows.mapInPandas(run, "doc_id bigint, codes array<bigint>"), docs=F.count("*"), words=F.sum(F.size("codes")))
    return out, seen["docs"], seen["words"] or 0


def document_frequencies(corpus: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """In how many documents each word of ``vocabulary`` (hashes, ascending) occurs."""
    shared = corpus.sparkSession.sparkContext.broadcast(vocabulary)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        count = np.zeros(len(known), dtype=np.int64)
        for frame in frames:
            for codes in frame["codes"]:
                once = np.unique(codes)
                at = np.minimum(np.searchsorted(known, once), len(known) - 1)
                count[at[known[at] == once]] += 1
        yield pd.DataFrame({"w": np.flatnonzero(count), "n": count[count > 0]})

    got = corpus.mapInPandas(run, "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(len(vocabulary))
    n[got["w"]] = got["n"]
    return n


def _common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, row by row with array operations."""
    best = np.zeros(len(b) + 1, dtype=np.int32)
    for x in a:
        step = np.concatenate([[0], np.maximum(best[1:], best[:-1] + (b == x))])
        best = np.maximum.accumulate(step)
    return int(best[-1])


def _holds(near: np.ndarray, span: np.ndarray) -> bool:
    return any(np.array_equal(near[s : s + len(span)], span) for s in np.flatnonzero(near == span[0]))


def _asked(b: Block, exact: dict[int, dict[int, list[int]]], anchors: list[tuple[int, int, int]], has: Callable[[int], set[int]]) -> np.ndarray:
    """(document, first word of the window, passage) of all cosines to be taken, in order. A passage of whose answers the
    document (``has``: its words) lacks a word is not asked for."""
    out: set[tuple[int, int, int]] = set()

    def around(d: int, at: int, p: int) -> None:
        step = b.steps[p]
        first = at // step * step
        out.add((d, first, p))
        if first:
            out.add((d, first - step, p))

    for d, items in exact.items():
        for k, places in items.items():
            for p in b.of_item[k]:
                for at in places:
                    around(d, at, p)
    owner = b.owner.tolist()
    none: dict[int, list[int]] = {}
    last, present = -1, set()
    for d, at, word in anchors:
        if d != last:
            last, present = d, has(d)
        held = exact.get(d, none)
        for p, within in b.anchored[word]:
            if owner[p] not in held and b.answer_words[p] <= present:
                # the window that has the passage in its middle, and the two that any run near by has
                out.add((d, max(0, at - within - b.spare[p]), p))
                around(d, at, p)
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 3)


def _cosines(b: Block, codes: np.ndarray, starts: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The cosine of each window to its passage; windows asked for several passages are summed once."""
    document, first, passage = asked.T
    step = np.array(b.steps, dtype=np.int64)[passage]
    windows, which = np.unique(np.column_stack([starts[document] + first, np.minimum(starts[document] + first + 2 * step, starts[document + 1] - 1)]), axis=0, return_inverse=True)
    which = which.reshape(-1)
    order = np.argsort(which, kind="stable")
    out, at = np.empty(len(asked), dtype=np.float32), 0
    for lo in range(0, len(windows), 1024):
        some = windows[lo : lo + 1024]
        sizes = some[:, 1] - some[:, 0]
        ends = np.cumsum(sizes)
        inside = np.arange(ends[-1]) + np.repeat(some[:, 0] - (ends - sizes), sizes)
        sums = np.add.reduceat(b.rows[codes[inside]], ends - sizes, axis=0)
        sums /= np.linalg.norm(sums, axis=1, keepdims=True) + 1e-12
        upto = at + int(np.searchsorted(which[order[at:]], lo + 1024))
        mine = order[at:upto]
        for k in range(0, len(mine), 16_384):
            part = mine[k : k + 16_384]
            out[part] = np.einsum("ij,ij->i", sums[which[part] - lo], b.latent[passage[part]])
        at = upto
    return out


def _in_documents(b: Block, docs: list[np.ndarray]) -> Iterator[tuple[int, int, str, float, float | None]]:
    """(document, item, kind, cosine, lcs_share). All documents are looked through as one array, with -1 between them;
    only windows that hold something are taken up one by one."""
    starts = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])])
    flat = np.zeros(starts[-1], dtype=np.int64)
    for d, at in zip(docs, starts):
        flat[at : at + len(d)] = d
    codes = b.numbers(flat)
    codes[starts[1:] - 1] = -1
    is_anchor = np.zeros(len(b.hashes) + 1, dtype=bool)
    is_anchor[list(b.anchored)] = True
    exact: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
    for at, k in b.found(codes):
        d = int(np.searchsorted(starts, at, "right")) - 1
        exact[d][k].append(at - int(starts[d]))
    where = np.flatnonzero(is_anchor[codes])
    d = np.searchsorted(starts, where, "right") - 1
    asked = _asked(b, exact, list(zip(d.tolist(), (where - starts[d]).tolist(), codes[where].tolist())), lambda d: set(codes[starts[d] : starts[d + 1] - 1].tolist()))
    if not len(asked):
        return
    cosines = _cosines(b, codes, starts, asked)
    owner = b.owner[asked[:, 2]]
    best: dict[tuple[int, int], tuple[str, float, float | None]] = {}
    held = np.array([k in exact.get(d, ()) for d, k in zip(asked[:, 0].tolist(), owner.tolist())])
    for i in np.flatnonzero(held | (cosines >= PARAPHRASE_COSINE)):
        (d, at, p), cosine = asked[i].tolist(), float(cosines[i])
        key = (d, int(owner[i]))
        if key in best and best[key][1] >= cosine:
            continue
        if held[i]:
            best[key] = ("verbatim", cosine, None)
            continue
        passage = b.passage(p)
        document = codes[starts[d] : starts[d + 1] - 1]
        near = document[max(0, at - len(passage)) : at + 2 * b.steps[p] + len(passage)]
        if np.isin(passage, near).mean() >= PARAPHRASE_SHARE and all(_holds(near, s) for s in b.needed[p]):
            share = _common_subsequence(passage, near) / len(passage)
            if share >= PARAPHRASE_SHARE:
                best[key] = ("paraphrase", cosine, share)
    for (d, k), got in best.items():
        yield d, k, *got


def _chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    first, n = 0, 0
    for k, size in enumerate(sizes):
        n += size
        if n >= CHUNK_WORDS:
            yield first, k + 1
            first, n = k + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


def _search(blocks: list):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, docs = [], []
        for frame in frames:
            ids += frame["doc_id"].tolist()
            docs += [np.asarray(c, dtype=np.int64) for c in frame["codes"]]
        for shared in blocks:
            b = shared.value
            for lo, hi in _chunks([len(d) for d in docs]):
                rows = [(ids[lo + d], b.ids[k], *rest) for d, k, *rest in _in_documents(b, docs[lo:hi])]
                if rows:
                    yield pd.DataFrame(rows, columns=["doc_id", "item_id", "kind", "cosine", "lcs_share"]).astype({"lcs_share": "float64"})

    return run


def _blocks(evaluation: DataFrame) -> list[Block]:
    rows = evaluation.filter("item_id is not null and text is not null").select("item_id", "text").distinct().orderBy("item_id", "text")
    out, mine, size = [], [], 0
    for r in rows.toLocalIterator():
        ws = words(r["text"])
        if mine and ws and size + len(ws) > BLOCK_WORDS:
            out.append(Block.of(mine))
            mine, size = [], 0
        if ws:
            mine.append((r["item_id"], r["text"], ws))
            size += len(ws)
    return [*out, Block.of(mine)] if mine else out


def leaks(documents: DataFrame, evaluation: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``kind`` (verbatim or paraphrase), ``cosine``, ``lcs_share`` (paraphrases only)."""
    spark = documents.sparkSession
    schema = "doc_id bigint, item_id bigint, kind string, cosine double, lcs_share double"
    blocks = _blocks(evaluation)
    if not blocks:
        return spark.createDataFrame([], schema)
    corpus, docs, size = coded(documents)
    vocabulary = np.unique(np.concatenate([b.hashes for b in blocks]))
    frequency = document_frequencies(corpus, vocabulary)
    shared = []
    for b in blocks:
        idf = (np.log((docs + 1) / (frequency[np.searchsorted(vocabulary, b.hashes)] + 1)) + 1).astype(np.float32)
        row, col, weight = triples = b.triples(idf)
        space = randomised_svd(spark.createDataFrame(pd.DataFrame({"row": row, "col": col, "weight": weight.astype("float64")})), len(b.hashes))
        b.finish(idf, space, triples)
        shared.append(spark.sparkContext.broadcast(b))
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-size // TASK_WORDS), -(-docs // TASK_DOCS))
    out = corpus.repartition(tasks, "doc_id").mapInPandas(_search(shared), schema)
    best = out.groupBy("doc_id", "item_id").agg(F.min_by(F.struct("kind", "cosine", "lcs_share"), F.struct(F.col("kind") != "verbatim", -F.col("cosine"))).alias("b"))
    return best.select("doc_id", "item_id", "b.kind", "b.cosine", "b.lcs_share")
