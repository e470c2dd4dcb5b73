"""Token counts of whole texts by the whole-token shortcut.

A byte-level vocabulary is checked offline, once, before any text is read: a
vocabulary string that the merges build from its bytes as one token, and that the
splitting pattern leaves whole, encodes alone as one token. The ids of the proven
strings go out with the job (four bytes each, at most the vocabulary). A pre-token
among these counts one without merging; only the rest is merged, through the rank
queue of ``byte_bpe``, and short results are remembered. Special strings inside a text
count as their one token and split the text, as the library does by default. A file
that asks for anything else (a normalizer, another splitting, other merge options or
added tokens that take in blanks) is refused.

Null and empty texts have no tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import Merges, Remembered, send_file

LIMIT = 512

# The splitting pattern of byte-level pre-tokenisation.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes: themselves where printable in Latin-1, else 256 and up in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(c): b for c, b in [*zip(plain, plain), *zip(range(256, 256 + len(rest)), rest)]}


# The settings that this counter implements, as tokenizer files name them.
SETTINGS = {"normalizer": None, "truncation": None, "padding": None}
SPLITTING = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
ADDED = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}


def check_settings(model: dict) -> None:
    """Raise for a file whose settings would change a count."""
    asked = [(model, SETTINGS), (model.get("pre_tokenizer") or {}, SPLITTING), (model["model"], MODEL), *((t, ADDED) for t in model.get("added_tokens", []))]
    for found, wanted in asked:
        if other := {k: found[k] for k, value in wanted.items() if k in found and found[k] != value} or not found and wanted:
            raise ValueError(f"tokenizer settings not covered: {other}")


class Counter:
    """Number of tokens of texts; pre-tokens proven to be whole tokens (``proven``, their ids, or else proven here) are never merged."""

    def __init__(self, model: dict, proven: np.ndarray | None = None):
        check_settings(model)
        alphabet = byte_alphabet()
        vocab = model["model"]["vocab"]
        raw = {t: bytes(alphabet[c] for c in t) for t in vocab}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        single = [0] * 256
        for char, byte in alphabet.items():
            single[byte] = vocab[char]
        self.merges = Merges(len(pairs), single, lambda a, b: ranks.get((a, b), -1), [vocab[a + b] for a, b in pairs])
        self.memory = Remembered(PATTERN, self._counts)
        special = [t["content"] for t in model.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        if proven is None:
            self.proven = frozenset(self._prove(raw))
        else:
            text_of = {i: t for t, i in vocab.items()}
            self.proven = frozenset(raw[text_of[i]].decode() for i in proven.tolist())

    def _prove(self, raw: dict[str, bytes]) -> list[str]:
        """Vocabulary strings that are one pre-token and one token alone."""
        alone = []
        for token in raw.values():
            try:
                text = token.decode()
            except UnicodeDecodeError:
                continue  # part of a character, never a pre-token
            if self.memory.pattern.findall(text) == [text]:
                alone.append(text)
        return [text for text, n in zip(alone, self.merges.results(alone, self._lengths)) if n == 1]

    @staticmethod
    def _lengths(ids: np.ndarray, ends: np.ndarray) -> list[int]:
        return np.diff(ends, prepend=0).tolist()

    def _counts(self, tokens: list[str]) -> list[int]:
        rest = iter(self.merges.results([t for t in tokens if t not in self.proven], self._lengths))
        return [1 if t in self.proven else next(rest) for t in tokens]

    def _parts(self, texts, specials: list[int]) -> Iterator[str]:
        """Texts cut at special strings, whose number per text is appended to ``specials`` first."""
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            specials.append(len(parts) - 1)
            yield from parts

    def count(self, texts) -> Iterator[int]:
        """Number of tokens of each text."""
        specials: list[int] = []
        n = parts = at = 0
        for last, counts in self.memory.look_up(self._parts(texts, specials)):
            n += sum(counts)
            parts += last
            if last and parts > specials[at]:
                yield n + specials[at]
                n, parts, at = 0, 0, at + 1


_counters: dict[str, Counter] = {}


def worker_counter(name: str, proven: np.ndarray) -> Counter:
    """The counter of this Python worker."""
    if name not in _counters:
        with open(SparkFiles.get(name), encoding="utf-8") as file:
            _counters[name] = Counter(json.load(file), proven)
    return _counters[name]


def proven_ids(path: str) -> np.ndarray:
    """Ids of the vocabulary strings that encode alone as one token: the offline proof."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    alphabet, vocab = byte_alphabet(), model["model"]["vocab"]
    whole = {text.encode() for text in Counter(model).proven}
    return np.array(sorted(i for t, i in vocab.items() if bytes(alphabet[c] for c in t) in whole), np.int32)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row, by the vocabulary file at ``path``."""
    name = send_file(docs, path)
    proven = docs.sparkSession.sparkContext.broadcast(proven_ids(path))

    def run(batches):
        counter = worker_counter(name, proven.value)
        for batch in batches:
            counts = list(counter.count(t.as_py() or "" for t in batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])
        counter.memory.rest()
        counter.merges.forget()

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
