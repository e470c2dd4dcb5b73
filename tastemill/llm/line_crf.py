"""Quality rules with line labels: a linear-chain conditional random field marks lines as content or boilerplate.

Lines are described by a few shares (signs, capitals, repeated words, repeated
lines, length, sentence ends); the field adds how labels follow each other, and
Viterbi decoding labels whole texts. The share of words in content lines decides
on retention, beside two base rules. Weights are trained by gradient ascent on
the lines of at most ``SAMPLE`` labelled documents (those with the least hash
of their id; a text of more than ``SAMPLE_LINES`` lines is not learnt from, so that
the sample has a bound in lines too), every line carrying its document's label,
around a prior that holds without any labels. Counts and decisions cover whole texts.

A null or empty text has no words, fails the base rules and is not kept.
Repeated rows are judged alike; repeated labels of a document are averaged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, blocks, mix, spans_hash, text_buffer, windows

SAMPLE = 1000
SAMPLE_LINES = 1000
CONTENT_SHARE = 0.5
MIN_WORDS = 10
REPEAT_WINDOW = 5
REPEAT_PERCENT = 20

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTERS = _UPPER.copy()
_LETTERS[0x61:0x7B] = True
_HEADS = (np.arange(256) & 0xC0) != 0x80

FEATURES = ("bias", "signs", "capitals", "repeats", "seen", "short", "length", "sentence")
# Weights of boilerplate against content before any training.
PRIOR = np.array([-2.0, 4.0, 3.0, 3.0, 2.0, 0.3, 0.0, -0.5])
PRIOR_MOVES = np.array([[0.7, -0.7], [-0.7, 0.7]])  # from content or boilerplate to either


class Lines:
    """The lines of several texts: counts of the base rules and features of the lines with a word."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        words = Words(buf, offsets)
        self.words, rows = words, len(offsets) - 1
        breaks = np.flatnonzero(buf == 0x0A)
        starts = np.union1d(breaks + 1, offsets[:-1][np.diff(offsets) > 0])
        starts = starts[starts < len(buf)]
        self.starts = starts
        ends = np.append(starts[1:], len(buf))
        ends = ends - ((ends > starts) & (buf[np.maximum(ends - 1, 0)] == 0x0A)) if len(buf) else ends
        line_of = np.searchsorted(starts, words.starts, side="right") - 1
        n = np.bincount(line_of, minlength=len(starts))
        text_of = np.searchsorted(offsets[1:], starts, side="right")

        def total(mask: np.ndarray) -> np.ndarray:
            return np.bincount(np.searchsorted(starts, np.flatnonzero(mask), side="right") - 1, minlength=len(starts))

        signs, upper, letters = total(_SYMBOLS[buf]), total(_UPPER[buf]), total(_LETTERS[buf])
        self.n_symbols = np.bincount(text_of, signs, rows).astype(np.int64)
        heads = np.concatenate(([0], np.cumsum(_HEADS[buf])))
        chars = heads[words.ends] - heads[words.starts]
        self.word_chars = np.bincount(words.owners(), chars, rows).astype(np.int64)
        hashes = words.hashes()
        distinct = np.unique(hashes ^ mix(line_of.astype(np.uint64)), return_index=True)[1]
        fresh = np.bincount(line_of[distinct], minlength=len(starts))
        full = np.flatnonzero(n > 0)
        seen = self._seen(buf, starts, ends, text_of, full)
        self.n_dup_lines = np.bincount(text_of[full], seen[full], rows).astype(np.int64)
        self.n_repeat_words = self._repeats(hashes, rows)
        last = words.ends[np.cumsum(n)[full] - 1] - 1 if len(full) else full
        m = n[full]
        self.text, self.count = text_of[full], m
        self.features = np.column_stack([
            np.ones(len(full)), np.minimum(signs[full] / np.maximum(m, 1), 1.0), upper[full] / np.maximum(letters[full], 1), 1 - fresh[full] / np.maximum(m, 1),
            seen[full], m < 5, np.log1p(m) / 5, np.isin(buf[last], list(b".!?")) if len(full) else full,
        ]) if len(full) else np.zeros((0, len(FEATURES)))

    @staticmethod
    def _seen(buf, starts, ends, text_of, full) -> np.ndarray:
        """1 for lines with a word that equal an earlier line of their text."""
        seen = np.zeros(len(starts))
        if not len(full):
            return seen
        value = spans_hash(buf, starts[full], ends[full]) if buf.dtype == np.uint64 else spans_hash(buf.astype(np.uint64) + np.uint64(1), starts[full], ends[full])
        order = np.lexsort((value, text_of[full]))
        same = (value[order][1:] == value[order][:-1]) & (text_of[full][order][1:] == text_of[full][order][:-1])
        data = buf.tobytes()
        for text in np.unique(text_of[full][order][1:][same]).tolist():  # exact: only texts with equal hashes
            known: set[bytes] = set()
            for k in full[text_of[full] == text].tolist():
                line = data[starts[k]:ends[k]]
                seen[k] = line in known
                known.add(line)
        return seen

    def _repeats(self, hashes: np.ndarray, rows: int) -> np.ndarray:
        """Words in windows that are found twice or more in their text."""
        words = self.words
        at = windows(words.first, REPEAT_WINDOW)
        out = np.zeros(rows, np.int64)
        if not len(at):
            return out
        value, text = spans_hash(hashes, at, at + REPEAT_WINDOW), np.searchsorted(words.first, at, side="right") - 1
        order = np.lexsort((value, text))
        same = (value[order][1:] == value[order][:-1]) & (text[order][1:] == text[order][:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        data, hit = words.buf.tobytes(), np.zeros(len(hashes) + 1, np.int64)
        places: dict[tuple, list[int]] = {}
        for k, t in zip(at[twice].tolist(), text[twice].tolist()):
            places.setdefault((t, *(data[words.starts[j]:words.ends[j]] for j in range(k, k + REPEAT_WINDOW))), []).append(k)
        for found in places.values():
            if len(found) > 1:
                hit[found] += 1
                hit[np.array(found) + REPEAT_WINDOW] -= 1
        covered = np.concatenate(([0], np.cumsum(np.cumsum(hit[:-1]) > 0)))
        return covered[words.first[1:]] - covered[words.first[:-1]]


def viterbi(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best labels (1: boilerplate) of one text; ``scores`` are those of boilerplate against content, line by line."""
    cc, cb, bc, bb = moves.ravel().tolist()
    content, boiler, back = 0.0, float(scores[0]), []
    for s in scores[1:].tolist():
        from_c, from_b = content + cb > boiler + bb, content + cc >= boiler + bc
        back.append((from_b, from_c))
        content, boiler = (content + cc if from_b else boiler + bc), s + (content + cb if from_c else boiler + bb)
    labels = [int(boiler > content)]
    for to_content, to_boiler in reversed(back):
        came_from_content = to_boiler if labels[-1] else to_content
        labels.append(0 if came_from_content else 1)
    return np.array(labels[::-1])


def fit(texts: list[np.ndarray], labels: list[int], rounds: int = 60, rate: float = 4.0, prior: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Weights and moves that raise the likelihood of the labels of whole texts, all texts at once, line number by line number."""
    weights, moves = PRIOR.copy(), PRIOR_MOVES.copy()
    if not texts:
        return weights, moves
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    longest, n = len(texts[order[0]]), sum(map(len, texts))
    x = np.zeros((len(order), longest, len(FEATURES)))
    live = np.zeros((len(order), longest), bool)
    for row, k in enumerate(order):
        x[row, :len(texts[k])], live[row, :len(texts[k])] = texts[k], True
    y = np.array([labels[k] for k in order])
    target = (x * (live * y[:, None])[:, :, None]).sum((0, 1))
    pairs = live[:, 1:].sum(1)
    target_moves = np.diag([pairs[y == 0].sum(), pairs[y == 1].sum()]).astype(float)
    for _ in range(rounds):
        score = np.stack([np.zeros(x.shape[:2]), x @ weights], 2) * live[:, :, None]
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for t in range(1, longest):
            step = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, axis=1) + score[:, t]
            forward[:, t] = np.where(live[:, t, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(moves + (score[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(live[:, t + 1, None], step, 0)
        norm = np.logaddexp.reduce(forward[:, -1], axis=1)
        chance = np.exp(forward + backward - norm[:, None, None])[:, :, 1] * live
        joint = np.exp(forward[:, :-1, :, None] + moves + (score + backward)[:, 1:, None, :] - norm[:, None, None, None]) * live[:, 1:, None, None]
        weights += rate * ((target - (x * chance[:, :, None]).sum((0, 1))) / n - prior * (weights - PRIOR))
        moves += rate * ((target_moves - joint.sum((0, 1))) / n - prior * (moves - PRIOR_MOVES))
    return weights, moves


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_lines: int = SAMPLE_LINES) -> tuple[np.ndarray, np.ndarray]:
    """Weights from the lines of at most ``sample`` labelled documents of at most ``sample_lines`` lines each."""
    known = labels.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.avg("quality").alias("_quality")).where("_quality IS NOT NULL AND _id IS NOT NULL")
    chosen = F.broadcast(known.orderBy(F.xxhash64("_id"), "_id").limit(sample))  # at most ``sample`` rows

    def run(batches):
        for block in blocks(batches):
            lines = Lines(*text_buffer(block.column("text")))
            cut = np.searchsorted(lines.text, np.arange(block.num_rows + 1))
            rows = [lines.features[a:b].ravel() if b - a <= sample_lines else [] for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([block.column("_id"), block.column("_quality"), pa.array(rows, pa.list_(pa.float64()))], names=["id", "quality", "features"])

    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(chosen, "_id").select("_id", "_quality", "text").mapInArrow(run, "id long, quality double, features array<double>")
    rows = [r for r in sorted(texts.collect(), key=lambda r: r.id) if r.features]
    return fit([np.array(r.features).reshape(-1, len(FEATURES)) for r in rows], [int(r.quality < 0.5) for r in rows])


def judge(docs: DataFrame, weights: np.ndarray, moves: np.ndarray) -> DataFrame:
    """doc_id, the base counts, content_words, base_failed and kept of every row."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words"]

    def run(batches):
        for block in blocks(batches):
            lines = Lines(*text_buffer(block.column("text")))
            scores = lines.features @ weights
            content = np.zeros(block.num_rows, np.int64)
            cut = np.searchsorted(lines.text, np.arange(block.num_rows + 1)).tolist()
            for row, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
                if b > a:
                    content[row] = (lines.count[a:b] * (1 - viterbi(scores[a:b], moves))).sum()
            n = lines.words.counts
            failed = (n < MIN_WORDS) | (100 * lines.n_repeat_words > REPEAT_PERCENT * n)
            kept = ~failed & (content >= CONTENT_SHARE * n)
            columns = (n, lines.word_chars, lines.n_symbols, lines.n_dup_lines, lines.n_repeat_words, content)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), *(pa.array(np.asarray(c, np.int64)) for c in columns), pa.array(failed), pa.array(kept)],
                                             names=["doc_id", *names, "base_failed", "kept"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, " + "".join(f"{c} long, " for c in names) + "base_failed boolean, kept boolean")


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, *train(docs, labels))
