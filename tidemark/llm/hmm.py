"""LM scoring: a hidden Markov language model over words.

A word w belongs to one class, by its spelling alone; a state s emits a class, and a class emits its words:
P(w | s) = P(class | s) P(w | class). The first factor and the transitions are trained by Baum-Welch, with counts
that are added up over all training documents; the second is counted over all words. Baum-Welch starts from a model
of neighbouring classes, whose counts also cover all training documents. Every chunk of documents
keeps its tokens as indices into its own distinct words, so that the passes move class counts and the join moves
distinct words, never tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ready
from .textbytes import Words, mix, words

_U = np.uint64
#: The end of a text: its hash, and its class.
END = 0x5E1F_0FD0_C0FF_EE01
CHUNK_SCHEMA = "chunk long, ids array<long>, held array<boolean>, lens array<int>, idx binary, words array<long>, counts array<int>, classes array<short>"


class Hmm(NamedTuple):
    start: np.ndarray  # S
    move: np.ndarray  # S x S
    emit: np.ndarray  # classes x S


def pack_indices(idx: np.ndarray) -> bytes:
    """Indices as compressed planes of bytes: the high ones are nearly all zero."""
    return pa.compress(np.ascontiguousarray(idx.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def unpack_indices(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def word_classes(w: Words, classes: int) -> np.ndarray:
    """Short words have a class by their whole spelling, longer ones by their last three bytes; class 0 is the end's."""
    n = w.end - w.start
    pad = np.concatenate([np.zeros(3, np.uint8), w.data])
    tail = pad[w.end].astype(_U) | (pad[w.end + 1].astype(_U) << _U(8)) | (pad[w.end + 2].astype(_U) << _U(16))
    h = np.where(n <= 5, w.hash, mix(tail + _U(1)))
    return (h % _U(classes - 1)).astype(np.int32) + 1


def _chunks(classes: int, most: int):
    if classes > 1 << 15:
        raise ValueError("classes are kept in 15 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids, held, lens, toks, cls, size = [], [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            t, c, n = np.concatenate(toks), np.concatenate(cls), np.concatenate(lens)
            distinct, at, idx, times = np.unique(t, return_index=True, return_inverse=True, return_counts=True)
            order = np.argsort(-times, kind="stable")  # frequent words first: small indices, which compress well
            distinct, at = distinct[order], at[order]
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            idx = rank[idx]
            learn = np.repeat(~np.array(held, bool), n)
            counts = np.bincount(idx[learn], minlength=len(distinct))
            one = [
                [(part << 32) + seq], [ids], [held], [n.astype(np.int32)], [pack_indices(idx)],
                [distinct.view(np.int64)], [counts.astype(np.int32)], [c[at].astype(np.int16)],
            ]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int16())]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(one, kinds, strict=True)], CHUNK_SCHEMA.replace(",", "").split()[::2])

        for b in batches:
            doc_ids, out = b.column(0).to_pylist(), b.column(2).to_pylist()
            for w in words(b.column(1)):
                n = np.diff(w.ptr)
                pos = w.ptr[1:]  # an end after each document's words
                toks.append(np.insert(w.hash, pos, _U(END)))
                cls.append(np.insert(word_classes(w, classes), pos, 0))
                lens.append(n + 1)
                ids += doc_ids[w.lo : w.hi]
                held += out[w.lo : w.hi]
                size += len(w.data) + 16 * len(n)
                if size >= most:
                    yield flush()
                    seq += 1
                    ids, held, lens, toks, cls, size = [], [], [], [], [], 0
        if ids:
            yield flush()

    return run


class Segments:
    """Documents cut into segments of at most ``length`` tokens, longest first, so that all advance together."""

    def __init__(self, lens: np.ndarray, length: int = 128):
        per = -(-lens // length)
        self.doc = np.repeat(np.arange(len(lens)), per)
        self.rank = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        first = np.cumsum(lens) - lens
        self.start = first[self.doc] + self.rank * length
        self.size = np.minimum(length, lens[self.doc] - self.rank * length)
        order = np.argsort(-self.size, kind="stable")
        self.doc, self.rank, self.start, self.size = (a[order] for a in (self.doc, self.rank, self.start, self.size))
        self.live = [int(np.searchsorted(-self.size, -t, "left")) for t in range(length + 1)]  # segments longer than t
        by_rank = np.argsort(self.rank, kind="stable")
        self.by_rank = np.split(by_rank, np.cumsum(np.bincount(self.rank))[:-1]) if len(lens) else []


def _products(m: Hmm, obs: np.ndarray, seg: Segments) -> tuple[np.ndarray, np.ndarray]:
    """Each segment's product of move and emission matrices, scaled, and the log of the scale."""
    k, s = len(seg.doc), len(m.start)
    e = m.emit[obs[seg.start]]
    p = m.move[None] * e[:, None, :]
    head = seg.rank == 0
    p[head] = 0
    p[head, 0] = m.start * e[head]
    log = np.zeros(k)
    for t in range(1, len(seg.live) - 1):
        n = seg.live[t]
        if not n:
            break
        q = (p[:n].reshape(-1, s) @ m.move).reshape(n, s, s) * m.emit[obs[seg.start[:n] + t]][:, None, :]
        if t % 6 == 0:
            c = q.sum((1, 2))
            q /= c[:, None, None]
            log[:n] += np.log(c)
        p[:n] = q
    c = p.sum((1, 2))
    return p / c[:, None, None], log + np.log(c)


def _ahead(p: np.ndarray, log: np.ndarray, seg: Segments, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """State weights before each segment, and each document's log likelihood."""
    s = p.shape[1]
    v = np.zeros((docs, s))
    v[:, 0] = 1
    before, ll = np.zeros((len(seg.doc), s)), np.zeros(docs)
    for at in seg.by_rank:
        d = seg.doc[at]
        before[at] = v[d]
        x = np.einsum("ns,nst->nt", v[d], p[at])
        c = x.sum(1)
        v[d] = x / c[:, None]
        ll[d] += np.log(c) + log[at]
    return before, ll


def log_likelihood(m: Hmm, obs: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Exact natural-log likelihood of each document's classes, by the scaled forward recursion over segments."""
    if not len(lens):
        return np.zeros(0)
    seg = Segments(lens)
    return _ahead(*_products(m, obs, seg), seg, len(lens))[1]


def expect(m: Hmm, obs: np.ndarray, lens: np.ndarray, group: int = 2048) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts of starts, moves and emissions, and the log likelihood."""
    s = len(m.start)
    starts, moves, emits = np.zeros(s), np.zeros((s, s)), np.zeros_like(m.emit)
    if not len(lens):
        return starts, moves, emits, 0.0
    seg = Segments(lens)
    p, log = _products(m, obs, seg)
    before, ll = _ahead(p, log, seg, len(lens))
    after, w = np.zeros_like(before), np.full((len(lens), s), 1.0)
    for at in reversed(seg.by_rank):
        d = seg.doc[at]
        after[at] = w[d]
        x = np.einsum("nst,nt->ns", p[at], w[d])
        w[d] = x / x.sum(1, keepdims=True)
    length = int(seg.size[0])
    for lo in range(0, len(seg.doc), group):
        g = slice(lo, min(lo + group, len(seg.doc)))
        size, start, head = seg.size[g], seg.start[g], seg.rank[g] == 0
        live = [min(max(seg.live[t] - lo, 0), len(size)) for t in range(length + 1)]
        alpha = np.zeros((length, len(size), s))
        e = m.emit[obs[start]]
        a = np.where(head[:, None], m.start, before[g] @ m.move) * e
        alpha[0] = a / a.sum(1, keepdims=True)
        for t in range(1, length):
            if not (n := live[t]):
                break
            a = (alpha[t - 1, :n] @ m.move) * m.emit[obs[start[:n] + t]]
            alpha[t, :n] = a / a.sum(1, keepdims=True)
        beta = after[g].copy()
        for t in range(length - 1, -1, -1):
            if not (n := live[t]):
                continue
            post = alpha[t, :n] * beta[:n]
            post /= post.sum(1, keepdims=True)
            alpha_t = alpha[t - 1, :n] if t else before[g][:n]
            eb = m.emit[obs[start[:n] + t]] * beta[:n]
            if t == 0:
                inner = ~head[:n]
                starts += post[head[:n]].sum(0)
                alpha_t, eb_in = alpha_t[inner], eb[inner]
            else:
                eb_in = eb
            norm = ((alpha_t @ m.move) * eb_in).sum(1, keepdims=True)
            moves += alpha_t.T @ (eb_in / norm)
            alpha[t, :n] = post
            if t:
                back = eb @ m.move.T
                beta[:n] = back / back.sum(1, keepdims=True)
        at = np.concatenate([start[: live[t]] + t for t in range(length)])
        post = np.concatenate([alpha[t, : live[t]] for t in range(length)])
        for j in range(s):
            emits[:, j] += np.bincount(obs[at], post[:, j], len(emits))
    return starts, moves * m.move, emits, float(ll.sum())


def improve(starts: np.ndarray, moves: np.ndarray, emits: np.ndarray, prior: float = 0.05) -> Hmm:
    """New parameters from expected counts; every state also follows the classes of all with a small weight."""
    all_ = emits.sum(1) + 1e-3
    e = emits + prior * 1000 * (all_ / all_.sum())[:, None]
    start, move = starts + 1.0, moves + 1.0
    return Hmm(start / start.sum(), move / move.sum(1, keepdims=True), e / e.sum(0))


def _sequences(b: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk: classes of its tokens, lengths, held flags, indices of its tokens."""
    get = lambda name: b.column(b.schema.get_field_index(name))[i]
    lens = get("lens").values.to_numpy(zero_copy_only=False).astype(np.int64)
    idx = unpack_indices(get("idx").as_py(), int(lens.sum()))
    return get("classes").values.to_numpy(zero_copy_only=False)[idx], lens, get("held").values.to_numpy(zero_copy_only=False), idx


def _learning(obs: np.ndarray, lens: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return obs[np.repeat(~held, lens)], lens[~held]


def _expectations(m: Hmm):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, k = len(m.start), len(m.emit)
        table = np.zeros((k + s + 2, s))  # classes, states, starts, and the log likelihood
        for b in batches:
            for i in range(b.num_rows):
                obs, lens, held, _ = _sequences(b, i)
                starts, moves, emits, ll = expect(m, *_learning(obs, lens, held))
                table[:k] += emits
                table[k : k + s] += moves
                table[-2] += starts
                table[-1, 0] += ll
        at = np.flatnonzero(table.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(table[at, j]) for j in range(s))], ["row", *(f"s{j}" for j in range(s))])

    return run


def _neighbours(coarse: np.ndarray):
    """How often a coarse class stands before another in a training document: (pair, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = int(coarse.max()) + 1
        n = np.zeros(k * k, np.int64)
        for b in batches:
            for i in range(b.num_rows):
                obs, lens, held, _ = _sequences(b, i)
                obs, lens = _learning(obs, lens, held)
                c = coarse[obs]
                inside = np.ones(max(len(c) - 1, 0), bool)
                inside[np.cumsum(lens)[:-1] - 1] = False  # not from one document to the next
                n += np.bincount((c[:-1] * k + c[1:])[inside], minlength=k * k)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["pair", "n"])

    return run


def pair_model(n: np.ndarray, states: int, steps: int = 150, tries: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Joint weights of neighbouring states, and each state's classes, that make the pair counts ``n`` likeliest.

    Expectation maximisation from fixed starting points, of which the best result counts.
    """
    best = None
    share = (n.sum(0) + n.sum(1) + 1.0) / (2 * n.sum() + len(n))
    for seed in range(tries):
        rng = np.random.default_rng(seed)
        e = share[:, None] * rng.gamma(0.5, size=(len(n), states)) + 1e-12
        e /= e.sum(0)
        j = rng.random((states, states)) + 0.5
        j /= j.sum()
        for _ in range(steps):
            p = e @ j @ e.T + 1e-300
            r = n / p
            e_new = e * (r @ e @ j.T + r.T @ e @ j) + 1e-9 * share[:, None]
            j = j * (e.T @ r @ e) + 1e-9
            j /= j.sum()
            e = e_new / e_new.sum(0)
        fit = float((n * np.log(e @ j @ e.T + 1e-300)).sum())
        if best is None or fit > best[0]:
            best = fit, j, e
    return best[1], best[2]


class Language(NamedTuple):
    hmm: Hmm
    tokens: int  # in training
    distinct: int
    class_tokens: np.ndarray
    class_distinct: np.ndarray


def _score(lang: Language):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        denominator = np.log10(lang.tokens + lang.distinct + 1)
        by_class = np.log10(lang.class_tokens + lang.class_distinct + 1)
        for b in batches:
            for i in range(b.num_rows):
                obs, lens, held, idx = _sequences(b, i)
                known = b.column(b.schema.get_field_index("known"))[i].values
                c = b.column(b.schema.get_field_index("counts"))[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
                if known is not None and len(known):
                    c[known.field("pos").to_numpy(zero_copy_only=False)] = known.field("c").to_numpy(zero_copy_only=False)
                c = c[idx]
                doc = np.repeat(np.arange(len(lens)), lens)
                up = np.log10(c + 1)
                base = np.bincount(doc, up - denominator, len(lens))
                inside = np.bincount(doc, up - by_class[obs], len(lens))
                score = inside + log_likelihood(lang.hmm, obs, lens) / np.log(10)
                yield pa.RecordBatch.from_arrays(
                    [b.column(b.schema.get_field_index("ids"))[i].values, pa.array(held), pa.array(lens), pa.array(np.bincount(doc, c > 0, len(lens)).astype(np.int64)),
                     pa.array(np.full(len(lens), lang.tokens, np.int64)), pa.array(base), pa.array(score)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def _start(chunks: DataFrame, tokens: np.ndarray, states: int, coarse_classes: int) -> Hmm:
    """Parameters to start from: those of the likeliest model of pairs of neighbours, over all training documents.

    The most frequent classes count for themselves, the others in groups, so at most ``coarse_classes`` ** 2 counts
    come to the driver. They are whole numbers, so nothing depends on how the rows are dealt out.
    """
    k = min(coarse_classes, len(tokens))
    order = np.lexsort([np.arange(len(tokens)), -tokens])
    coarse = np.empty(len(tokens), np.int64)
    own = k * 3 // 4
    coarse[order[:own]] = np.arange(own)
    coarse[order[own:]] = own + np.arange(len(tokens) - own) % (k - own)
    got = chunks.select("idx", "classes", "lens", "held").mapInArrow(_neighbours(coarse), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(k * k)
    n[got.pair.to_numpy(np.int64)] = got.n.to_numpy(float)
    joint, e = pair_model(n.reshape(k, k), states)
    group = np.bincount(coarse, tokens + 1.0, k)
    emit = e[coarse] * ((tokens + 1.0) / group[coarse])[:, None]
    per = joint.sum(1)
    return improve(per * 1e3, joint * n.sum(), emit * per * (n.sum() + 1))


def train(chunks: DataFrame, tokens: np.ndarray, states: int, rounds: int, tolerance: float, coarse_classes: int = 512) -> Hmm:
    """Baum-Welch over all training documents, until a pass gains less than ``tolerance`` a token, or ``rounds`` passes."""
    classes, before = len(tokens), -np.inf
    model = _start(chunks, tokens, states, coarse_classes)
    for _ in range(rounds):
        sums = chunks.select("idx", "classes", "lens", "held").mapInArrow(_expectations(model), "row long, " + ", ".join(f"s{j} double" for j in range(states)))
        got = sums.groupBy("row").agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(states)]).toPandas()
        table = np.zeros((classes + states + 2, states))
        table[got.row.to_numpy(np.int64)] = got[[f"s{j}" for j in range(states)]].to_numpy()
        model = improve(table[-2], table[classes : classes + states], table[:classes])
        per_token = table[-1, 0] / max(int(tokens.sum()), 1)
        if per_token - before < tolerance:
            break
        before = per_token
    return model


def score_texts(
    docs: DataFrame, held_out, *, id_col: str = "doc_id", text_col: str = "text", states: int = 6, classes: int = 4096, rounds: int = 4,
    tolerance: float = 0.002, chunk_bytes: int = 4 << 20,
) -> DataFrame:
    """Log10 probability of each whole text under a model of the rows for which the column ``held_out`` is false.

    Returns ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``. The model starts from counts
    of neighbouring classes; then each Baum-Welch pass adds up counts over all training documents. ``classes`` x
    ``states`` numbers come to the driver. A word that training lacks has, in its class, the share of a word seen zero
    times plus one. Scores don't depend on the rows' order or partitions, but for rounding.

    Null or empty text: the end alone. Null and repeated ids: each row is a text of its own. A null ``held_out``
    counts as false. No training rows: scores are those of the smoothing alone. Empty input: empty output.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "hmm")
    ready(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    chunks = scratch.save(rows.mapInArrow(_chunks(classes, chunk_bytes), CHUNK_SCHEMA))
    each = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts", "classes")).alias("pos", "w")).select("chunk", "pos", F.col("w.words").alias("h"), F.col("w.counts").alias("n"), F.col("w.classes").alias("cls"))
    # A word has a row for each chunk that holds it. Its counts are added up on the way; a chunk knows by itself the
    # counts of words that no other has, so only the others are joined back.
    word = scratch.save(each.groupBy("h").agg(F.sum(F.col("n").cast("long")).alias("c"), F.count(F.lit(1)).alias("m"), F.min("cls").alias("cls")))
    per = word.where("c > 0").groupBy("cls").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).toPandas()  # at most `classes` rows
    tokens, distinct = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    tokens[per.cls], distinct[per.cls] = per.c, per.v
    known = scratch.save(each.select("chunk", "pos", "h").join(word.where("m > 1").select("h", "c"), "h").select("chunk", "pos", "c"))
    lang = Language(train(chunks, tokens, states, rounds, tolerance), int(tokens.sum()), int(distinct.sum()), tokens, distinct)
    own = known.groupBy("chunk").agg(F.collect_list(F.struct("pos", "c")).alias("known"))
    full = chunks.select("chunk", "ids", "held", "lens", "idx", "counts", "classes").join(own, "chunk", "left").drop("chunk")
    return full.mapInArrow(_score(lang), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
