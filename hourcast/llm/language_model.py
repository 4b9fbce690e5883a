"""LM scoring with a log-bilinear model trained by noise-contrastive estimation.

Tokens are A-Z lower-cased words and one end per text.  Every word belongs to one of
``CLASSES`` classes: the commonest words and the end are classes of their own, the
others are dealt by their last two bytes.  The model factors

    P(word | context) = P(class | classes of the two tokens before) * P(word | class)

The first factor is log-bilinear: the context vector is a linear map of the two
context classes' vectors, a class scores its dot product with it plus a bias.  It is
trained in numpy by noise-contrastive estimation over the counts of class triples of
*all* training texts, gathered by Spark: ``PASSES`` weighted passes over all of them, whose
table is bounded by the number of classes, without drawing examples.  One batched matrix product over all contexts
and a softmax then give normalised log-probabilities, a table of fixed size.  The
second factor is (c + 0.5) / (class total), with one unknown word per open class.

Counts cover all training texts; a count is looked up in a table of the commonest
``HEAD_WORDS`` words sent to every task, and for other words by a join.

Words are identified by 64-bit hashes.  Defined results: null text counts as empty and
has the end alone; equal rows are scored separately; a null id is learned from; with
no training text N and V are 0 and all words are unknown; an empty table gives an
empty table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm import _words as W
from hourcast.session import checkpoint_dir

CLASSES = 128
SUFFIX_CLASSES = 64
COMMON = CLASSES - SUFFIX_CLASSES - 1
END_CLASS = CLASSES - 1
HEAD_WORDS = 1 << 17
DIM, NOISE, PASSES, RATE, SEED = 24, 8, 200, 0.05, 7
#: The end of a text as a word hash.
END_HASH = W.U64(0x0123456789ABCDEF)

_LOWER_BYTE = np.arange(256, dtype=np.int64)
_LOWER_BYTE[ord("A"):ord("Z") + 1] += 32


class Tokens:
    """Tokens of a column's texts: hashes, suffix classes, and bounds per text."""

    def __init__(self, column: pa.Array):
        words = W.Words(column)
        n = len(words.bounds) - 1
        total = len(words.starts) + n
        where = np.arange(len(words.starts)) + words.doc_of_word()
        self.hash = np.full(total, END_HASH)
        self.hash[where] = words.hashes(lower=True)
        self.suffix = np.full(total, END_CLASS)
        if len(where):
            last = _LOWER_BYTE[words.data[words.ends - 1]]
            prior = np.where(words.ends - words.starts > 1, _LOWER_BYTE[words.data[np.maximum(words.ends - 2, 0)]], 0)
            self.suffix[where] = COMMON + ((last * 257 + prior) * 40503 >> 4) % SUFFIX_CLASSES
        self.bounds = words.bounds + np.arange(n + 1)
        self.doc = np.repeat(np.arange(n), np.diff(self.bounds))

    def classes(self, common: np.ndarray) -> np.ndarray:
        """Class of every token; ``common`` are the sorted hashes of the common words."""
        out = self.suffix.copy()
        if len(common):
            at = np.minimum(np.searchsorted(common, self.hash), len(common) - 1)
            hit = common[at] == self.hash
            out[hit] = at[hit]
        out[self.bounds[1:] - 1] = END_CLASS
        return out

    def contexts(self, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes two and one token before; the end stands before a text's first token."""
        one = np.concatenate([[END_CLASS], cls[:-1]])
        one[self.bounds[:-1]] = END_CLASS
        two = np.concatenate([[END_CLASS], one[:-1]])
        two[self.bounds[:-1]] = END_CLASS
        return two, one


# --- corpus counts --------------------------------------------------------------------

def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def flush():
        h, suffix = (np.concatenate(x) for x in zip(*held))
        held.clear()
        h, at, n = np.unique(h, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(suffix[at].astype(np.int32)), pa.array(n)], ["h", "suffix", "c"])

    for batch in batches:
        for part in W.slices(batch):
            t = Tokens(part.column(0))
            held.append((t.hash, t.suffix))
            size += len(t.hash)
            if size > 4_000_000:
                yield flush()
                size = 0
    if held:
        yield flush()


def _triples(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        total = np.zeros(CLASSES ** 3, np.int64)
        for batch in batches:
            for part in W.slices(batch):
                t = Tokens(part.column(0))
                cls = t.classes(common)
                two, one = t.contexts(cls)
                code, n = np.unique((two * CLASSES + one) * CLASSES + cls, return_counts=True)
                total[code] += n
        code = np.flatnonzero(total)
        for i in range(0, len(code), 1 << 18):
            part = code[i:i + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["code", "n"])
    return run


# --- model -----------------------------------------------------------------------------

def train(code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log10 P(class | context) as an array (two before, one before, class), learned by
    noise-contrastive estimation from triple counts.

    Every pass goes over all contexts that occur, each class weighted by its count; the
    noise classes are not drawn either, as there are few enough of them to take the
    expectation over ``NOISE`` of them per token exactly.
    """
    rng = np.random.default_rng(SEED)
    context, w = code // CLASSES, code % CLASSES
    unigram = np.bincount(w, weights=n, minlength=CLASSES) + 0.5
    noise = unigram / unigram.sum()
    log_kn = np.log(NOISE * noise).astype(np.float32)
    seen, row = np.unique(context, return_inverse=True)
    a, b = seen // CLASSES, seen % CLASSES
    share = np.zeros((len(seen), CLASSES), np.float32)       # of all tokens, per context and class
    share[row, w] = n / max(1.0, n.sum())
    expected = NOISE * share.sum(1)[:, None] * noise.astype(np.float32)[None, :]
    normal = lambda: rng.normal(0, 0.1, (CLASSES, DIM)).astype(np.float32)
    eye = np.eye(DIM, dtype=np.float32)
    par = {"R": normal(), "A": eye * 0.5, "B": eye.copy(), "Q": normal(), "bias": np.log(noise).astype(np.float32)}
    first = {k: np.zeros_like(v) for k, v in par.items()}
    second = {k: np.zeros_like(v) for k, v in par.items()}
    one_hot = np.arange(CLASSES)[:, None]
    from_a, from_b = ((one_hot == x[None, :]).astype(np.float32) for x in (a, b))

    for step in range(PASSES if len(code) else 0):
        ra, rb = par["R"][a], par["R"][b]
        v = ra @ par["A"] + rb @ par["B"]
        odds = v @ par["Q"].T + (par["bias"] - log_kn)
        chance = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
        g = (share + expected) * chance - share
        dv = g @ par["Q"]
        grad = {"Q": g.T @ v, "bias": g.sum(0), "A": ra.T @ dv, "B": rb.T @ dv,
                "R": from_a @ (dv @ par["A"].T) + from_b @ (dv @ par["B"].T)}
        rate = RATE * (1 - step / PASSES) + 1e-4
        for k, d in grad.items():
            first[k] = 0.9 * first[k] + 0.1 * d
            second[k] = 0.99 * second[k] + 0.01 * d * d
            par[k] = par[k] - (rate * (first[k] / (1 - 0.9 ** (step + 1))) / (
                np.sqrt(second[k] / (1 - 0.99 ** (step + 1))) + 1e-8)).astype(np.float32)
    # every context at once: one matrix product and a softmax
    v = ((par["R"] @ par["A"])[:, None, :] + (par["R"] @ par["B"])[None, :, :]).reshape(-1, DIM)
    s = v @ par["Q"].T + par["bias"]
    s -= s.max(1, keepdims=True)
    s -= np.log(np.exp(s).sum(1, keepdims=True))
    return (s / np.log(10)).astype(np.float32).reshape(CLASSES, CLASSES, CLASSES)


# --- scoring -------------------------------------------------------------------------------

def _score(names: list[str], shared):
    """Per text: what the broadcast tables say, and the words that need the join.

    Logarithms of counts and of class masses are taken over the unigram's denominator,
    so sums stay as small as the scores and lose no digits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, table, log_class, head, log_head = shared.value
        flat = table.ravel()
        task = TaskContext.get().partitionId() << 40
        made = 0
        for batch in batches:
            for part in W.slices(batch, "__text"):
                t = Tokens(part.column(part.schema.get_field_index("__text")))
                n = len(t.bounds) - 1
                cls = t.classes(common)
                two, one = t.contexts(cls)
                of_class = flat[(two * CLASSES + one) * CLASSES + cls] - log_class[cls]
                if len(head):
                    at = np.minimum(np.searchsorted(head, t.hash), len(head) - 1)
                    hit = head[at] == t.hash
                else:
                    at, hit = np.zeros(len(cls), np.int64), np.zeros(len(cls), bool)
                in_head = np.where(hit, log_head[at] if len(head) else 0.0, 0.0)
                rest = np.flatnonzero(~hit)
                # distinct words to be joined, per text
                key = np.lexsort((t.hash[rest], t.doc[rest]))
                d, h = t.doc[rest][key], t.hash[rest][key]
                first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])])) \
                    if len(d) else np.zeros(0, np.int64)
                times = np.diff(np.concatenate([first, [len(d)]]))
                lists = pa.array(np.searchsorted(d[first], np.arange(n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in names),
                     pa.array(task + made + np.arange(n)), pa.array(np.diff(t.bounds)),
                     pa.array(np.bincount(t.doc[hit], minlength=n)),
                     pa.array(np.bincount(t.doc, weights=in_head, minlength=n)),
                     pa.array(np.bincount(t.doc, weights=of_class, minlength=n)),
                     pa.ListArray.from_arrays(lists, pa.array(h[first].view(np.int64))),
                     pa.ListArray.from_arrays(lists, pa.array(times))],
                    [*names, "__row", "n_tokens", "__known", "__log", "__class", "__h", "__n"])
                made += n
    return run


def commonest(counts: DataFrame, rows: int) -> DataFrame:
    """The words of the greatest counts, ``rows`` at most: those above a bound that a
    histogram of the counts' lengths and first two digits gives (some 1,800 cells)."""
    digits = F.col("c").cast("string")
    cell = F.char_length(digits) * 100 + F.rpad(F.substring(digits, 1, 2), 2, "0").cast("int")
    total, least = 0, 10_000
    for i, n in sorted(map(tuple, counts.groupBy(cell.alias("cell")).count().collect()), reverse=True):
        if total + n > rows:
            break
        total, least = total + n, i
    return counts.filter(cell >= least)


def lm_scores(spark: SparkSession, docs: DataFrame, learn_from: Column, text: str = "text",
              keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every row with n_tokens, n_known, train_tokens, base_score
    (unigram) and score, both log10 probabilities of the whole text.

    ``learn_from`` is a condition on the columns of ``docs``.
    """
    W.bounded_batches(spark)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/lm-{uuid.uuid4().hex}"
    whole = F.coalesce(F.col(text), F.lit("")).alias("text")
    train_texts = docs.filter(learn_from).select(whole)
    (train_texts.mapInArrow(_word_counts, "h long, suffix int, c long")
     .groupBy("h").agg(F.min("suffix").alias("suffix"), F.sum("c").alias("c"))
     .write.parquet(f"{folder}/counts"))
    counts = spark.read.parquet(f"{folder}/counts")
    by_class = counts.groupBy("suffix").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).toArrow()
    total = int(np.sum(by_class["c"].to_numpy())) if by_class.num_rows else 0
    distinct = int(np.sum(by_class["v"].to_numpy())) if by_class.num_rows else 0
    top = commonest(counts, HEAD_WORDS).orderBy(F.desc("c"), "h").toArrow()
    head, head_c = top["h"].to_numpy().view(np.uint64), top["c"].to_numpy().astype(float)
    head_suffix = top["suffix"].to_numpy()
    # classes of their own: the commonest words but the end
    own = np.flatnonzero(head_suffix != END_CLASS)[:COMMON]
    own = own[np.argsort(head[own])]
    common = head[own].copy()

    shared = spark.sparkContext.broadcast(common)
    triples = (train_texts.mapInArrow(_triples(shared), "code long, n long")
               .groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toArrow())
    table = train(triples["code"].to_numpy(), triples["n"].to_numpy().astype(float))

    # mass of every class: its words' c + 0.5, and 0.5 for an unknown word if it is open
    mass = np.zeros(CLASSES)
    for s, c, v in zip(*(by_class[x].to_pylist() for x in ("suffix", "c", "v"))):
        mass[s] += c + 0.5 * v
    mass[COMMON:COMMON + SUFFIX_CLASSES] += 0.5
    for i, at in enumerate(own):
        mass[i] = head_c[at] + 0.5
        mass[head_suffix[at]] -= head_c[at] + 0.5
    mass[END_CLASS] = max(mass[END_CLASS], 0.5)
    log_class = np.log10(np.maximum(mass, 0.5))
    order = np.argsort(head)
    head, log_head = head[order], np.log10(head_c[order] + 0.5)
    bottom = float(np.log10(total + 0.5 * (distinct + 1)))
    tables = spark.sparkContext.broadcast((common, table, log_class - bottom, head, log_head - bottom))

    kept = [docs.schema[c] for c in keep]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    (docs.select(*keep, whole.alias("__text")).mapInArrow(
        _score(list(keep), tables), f"{schema}__row long, n_tokens long, __known long, __log double, "
        "__class double, __h array<long>, __n array<long>")
     .write.parquet(f"{folder}/texts"))
    texts = spark.read.parquet(f"{folder}/texts")
    rest = texts.select("__row", F.explode(F.arrays_zip("__h", "__n")).alias("w")).select(
        "__row", F.col("w.__h").alias("h"), F.col("w.__n").alias("n"))
    joined = rest.join(counts.select("h", "c"), "h", "left").groupBy("__row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * (F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5)) - bottom)).alias("more_log"))
    logs = F.col("__log") + F.coalesce("more_log", F.lit(0.0))
    return texts.join(joined, "__row", "left").select(
        *keep, "n_tokens", (F.col("__known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        logs.alias("base_score"),
        (logs + F.col("__class")).alias("score"))
