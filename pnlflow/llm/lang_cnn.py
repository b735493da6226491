"""Language ID: a byte convolutional network.

Bytes become classes (letters in lower case, one class for all that is no letter, each
byte above 7F its own), classes become small learned vectors, filters of several widths
run over them, the largest answer of each filter within a window is kept, and a softmax
names the language.  The network is trained here, in numpy, on a bounded sample of
labelled text and applied to every window of every text, in batches; a document's answer
is the mean over its windows, each weighted by its letters.

Defined results: a null text and one without letters are ``und`` with score 0.  Labels
that are null take no part in training; without any label every text is ``und``.  Ties go
to the language that comes first in alphabetical order.  Rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pnlflow.llm.common import slices, sums, utf8

UND = "und"
#: Byte -> class: 0 is "no letter", 1-26 the letters, the rest one for each byte above 7F.
CLASSES = np.zeros(256, np.uint8)
CLASSES[[*range(0x41, 0x5B)]] = CLASSES[[*range(0x61, 0x7B)]] = np.arange(1, 27)
CLASSES[128:] = np.arange(27, 155)
N_CLASSES = 155


@dataclass(frozen=True)
class Shape:
    """Window, network and training sample.  ``docs_per_lang`` and ``windows_per_doc`` bound
    the labelled rows that training sees; everything else reads all rows."""

    window: int = 256
    dim: int = 8
    widths: tuple[int, ...] = (2, 3, 4, 5)
    filters: int = 8
    docs_per_lang: int = 500
    windows_per_doc: int = 4
    epochs: int = 8
    batch: int = 64
    rate: float = 0.01
    seed: int = 11

    @property
    def stride(self) -> int:
        """Windows overlap by the widest filter less one, so that no n-gram is cut."""
        return self.window - max(self.widths) + 1


@dataclass
class Network:
    langs: list[str]
    shape: Shape
    embed: np.ndarray  # class x dim
    conv: np.ndarray  # (widest * dim) x filters; rows beyond a filter's own width stay 0
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pooled(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The filters' largest answers in each window, and the patches under all of them."""
        n, width = len(codes), max(self.shape.widths)
        x = self.embed[codes].reshape(n, -1)
        steps = codes.shape[1] - width + 1
        patches = np.lib.stride_tricks.as_strided(
            x, (n, steps, width * self.shape.dim), (x.strides[0], 4 * self.shape.dim, 4)).reshape(n * steps, -1)
        return (patches @ self.conv).reshape(n, steps, -1), patches.reshape(n, steps, -1)

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        best = [self.pooled(codes[k:k + 64])[0].max(axis=1) for k in range(0, len(codes), 64)]
        hidden = np.maximum(np.concatenate(best) + self.bias, 0)
        return softmax(hidden @ self.out + self.out_bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(codes: np.ndarray, answers: np.ndarray, langs: list[str], shape: Shape = Shape()) -> Network:
    """Fit the network by Adam on cross entropy; windows count so that languages weigh the same."""
    rng = np.random.default_rng(shape.seed)
    width, total = max(shape.widths), shape.filters * len(shape.widths)
    mask = np.zeros((width * shape.dim, total), np.float32)
    for k, w in enumerate(shape.widths):
        mask[:w * shape.dim, k * shape.filters:(k + 1) * shape.filters] = 1
    normal = lambda *s, by: (rng.standard_normal(s) * by).astype(np.float32)
    net = Network(langs, shape, normal(N_CLASSES, shape.dim, by=0.5), normal(width * shape.dim, total, by=0.2) * mask,
                  np.zeros(total, np.float32), normal(total, len(langs), by=0.2), np.zeros(len(langs), np.float32))
    share = np.bincount(answers, minlength=len(langs))
    weight = (len(answers) / len(langs) / np.maximum(share, 1))[answers].astype(np.float32)
    params = [net.embed, net.conv, net.bias, net.out, net.out_bias]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(shape.epochs):
        rate = shape.rate * (1 - epoch / shape.epochs)
        order = rng.permutation(len(codes))
        for k in range(0, len(order), shape.batch):
            pick = order[k:k + shape.batch]
            x, n = codes[pick], len(pick)
            answer, patches = net.pooled(x)
            at = answer.argmax(axis=1)  # window x filter
            pre = np.take_along_axis(answer, at[:, None, :], axis=1)[:, 0] + net.bias
            hidden = np.maximum(pre, 0)
            d = softmax(hidden @ net.out + net.out_bias)
            d[np.arange(n), answers[pick]] -= 1
            d *= weight[pick, None] / n
            up = (d @ net.out.T) * (pre > 0)
            seen = patches[np.arange(n)[:, None], at]  # window x filter x (width * dim)
            conv = np.einsum("nfp,nf->pf", seen, up) * mask
            back = np.einsum("nf,pf->nfp", up, net.conv).reshape(-1, shape.dim)
            rows = x[np.arange(n)[:, None, None], at[:, :, None] + np.arange(width)].reshape(-1)
            embed = np.zeros_like(net.embed)
            np.add.at(embed, rows, back)
            t += 1
            for p, g, m, v in zip(params, (embed, conv, up.sum(axis=0), hidden.T @ d, d.sum(axis=0)), first, second):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                p -= (rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-7)).astype(np.float32)
    return net


def windows(data: np.ndarray, at: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts as classes (class 0 beyond a text's end), and each one's text."""
    size = np.diff(at)
    count = np.where(size > 0, np.maximum(1, -(-(size - (shape.window - shape.stride)) // shape.stride)), 0)
    owner = np.repeat(np.arange(len(size)), count)
    start = at[:-1][owner] + (np.arange(len(owner)) - (np.cumsum(count) - count)[owner]) * shape.stride
    place = start[:, None] + np.arange(shape.window)
    codes = CLASSES[data[np.minimum(place, max(len(data) - 1, 0))]] if len(owner) else np.zeros((0, shape.window), np.uint8)
    codes[place >= at[1:][owner][:, None]] = 0
    return codes, owner


def _sample(shape: Shape):
    """Up to ``windows_per_doc`` windows of a text, spread evenly over all of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            codes, owner = windows(*utf8(batch.column("text")), shape)
            count = np.bincount(owner, minlength=batch.num_rows)
            first = np.cumsum(count) - count
            pick = [first[i] + k for i, c in enumerate(count) for k in np.unique(np.linspace(0, c - 1, min(c, shape.windows_per_doc)).astype(int)) if c]
            pick = [k for k in pick if (codes[k] > 0).sum() >= 16]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(owner[pick])), batch.column("rank").take(pa.array(owner[pick])),
                 pa.array([codes[k].tobytes() for k in pick], pa.binary())], names=["lang", "rank", "codes"])
    return run


def fit(docs: DataFrame, shape: Shape = Shape(), learn: Column | None = None) -> Network | None:
    """Train on rows where ``learn`` holds and text and lang are not null.

    The sample is bounded: of each language the ``docs_per_lang`` rows of the smallest hash of id,
    text and row number, found by a threshold that follows from the language's count, not by a
    sort.  Rows without ids, of one id or of one text are drawn like all others."""
    from functools import reduce

    rows = docs.withColumn("__row", F.monotonically_increasing_id()).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.lit(True) if learn is None else learn))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # one row for each language
    if not counts:
        return None
    rank = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text", "__row", F.lit(shape.seed)), F.lit(1 << 30))
    most = lambda c: int((1 << 30) * min(1.0, (shape.docs_per_lang + 4 * shape.docs_per_lang ** 0.5) / c))
    keep = reduce(lambda a, b: a | b, ((F.col("lang") == x) & (F.col("rank") < most(c)) for x, c in counts.items()))
    got = (rows.select("lang", rank.alias("rank"), "text").where(keep)
           .mapInArrow(_sample(shape), "lang string, rank long, codes binary").collect())
    langs = sorted(counts)
    got.sort(key=lambda r: (r.lang, r.rank, bytes(r.codes)))
    use, seen = [], {}
    for r in got:
        ranks = seen.setdefault(r.lang, set())
        if len(ranks) < shape.docs_per_lang or r.rank in ranks:
            ranks.add(r.rank)
            use.append(r)
    if not use:
        return None
    codes = np.frombuffer(b"".join(bytes(r.codes) for r in use), np.uint8).reshape(len(use), shape.window)
    return train(codes, np.array([langs.index(r.lang) for r in use]), langs, shape)


SCHEMA = "doc_id long, lang_pred string, score double, n_windows long"


def _apply(net: Network | None, whole_rows: bool = False):
    """Predictions, or with ``whole_rows`` the input's rows in a learned language (without a
    network: with letters)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            data, at = utf8(batch.column("text"))
            n = batch.num_rows
            letters = sums((CLASSES[data] > 0) & (data < 128), at)
            spoken = letters > 0
            for i in np.flatnonzero(~spoken & (np.diff(at) > 0)):  # letters beyond ASCII
                spoken[i] = any(c.isalpha() for c in data[at[i]:at[i + 1]].tobytes().decode("utf-8", "ignore"))
            names, score, count = np.array([UND] * n, object), np.zeros(n), np.zeros(n, np.int64)
            if net is not None and spoken.any():
                codes, owner = windows(data, at, net.shape)
                p = net.probabilities(codes) * (np.count_nonzero(codes, axis=1) + 1e-3)[:, None]
                mean = np.stack([np.bincount(owner, weights=c, minlength=n) for c in p.T], axis=1)
                mean /= np.maximum(mean.sum(axis=1, keepdims=True), 1e-30)
                best = mean.argmax(axis=1)
                names[spoken] = np.array(net.langs, object)[best[spoken]]
                score[spoken] = np.clip(mean[np.arange(n), best], 0, 1)[spoken]
                count = np.bincount(owner, minlength=n)
            if whole_rows:
                yield batch.filter(pa.array(spoken if net is None else names != UND))
                continue
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(names.tolist(), pa.string()), pa.array(score), pa.array(count.astype(np.int64))],
                names=["doc_id", "lang_pred", "score", "n_windows"])
    return run


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, predicted language and its probability for every row.  The network is a few
    kilobytes, whatever the corpus; predictions see nothing but the text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_apply(net), SCHEMA)


def spoken_rows(docs: DataFrame, net: Network | None) -> DataFrame:
    """The rows of ``docs`` that are text in a learned language, with all their columns.

    The network chooses among the languages it was taught, so it rejects a text only if ``und``
    is one of them and its answer; else what goes is null text and text without letters.
    Without a network nothing is known of languages, and every text with letters stays."""
    return docs.mapInArrow(_apply(net, whole_rows=True), docs.schema)
