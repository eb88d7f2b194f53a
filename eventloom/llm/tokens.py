"""Token counting and encoding with a word-level BPE vocabulary, exact to the tokenizer library.

A text falls apart at white space, since neither the normalizer nor the pre-tokenizer of such a
vocabulary joins anything across it, so chunks between white space are encoded once and kept.

Whole-token shortcut: `whole_tokens` proves offline which vocabulary strings encode alone as exactly
one token, by encoding each of them. A pre-token that matches one counts one; only the remaining
pre-tokens are merged, many at a time, by array operations that are held against the library first.

Chunks outside plain Latin letters, and texts that hold a special string, go to the library whole.
"""

from __future__ import annotations

import gc
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventloom.llm.common import release

#: Entries of a worker's chunk memory; when full, only those of the present block stay.
MEMORY = 300_000
#: Pre-token pattern of the vocabulary, restricted to the characters that take the fast path.
LATIN = "a-zß-öø-ÿ"
PRETOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN}ªµº]+|[0-9²³¹¼½¾]|[^\s0-9{LATIN}ªµº²³¹¼½¾]+")
#: Characters whose lower case and composed form are fixed and the same everywhere: ASCII and Latin-1.
PLAIN = re.compile(r"[\x21-\x7e\xa1-\xac\xae-\xff]+")
PLAIN_TEXT = re.compile(r"[\t\n\x0b\x0c\r\x20-\x7e\xa1-\xac\xae-\xff]*")


def default_tokenizer() -> str:
    """The word-level vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[str, int]:
    """Byte-level BPE writes each byte as a printable letter; this maps the letters back."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in printable}
    letters.update({chr(0x100 + i): b for i, b in enumerate(x for x in range(256) if x not in set(printable))})
    return letters


class Merger:
    """Byte-pair merges of many short strings at once, as array operations.

    In every round each string merges its pair of lowest rank (the leftmost such pair). As a merge
    only yields pairs of higher rank than its own, that is the order of the library.
    """

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        letters = {b: c for c, b in _byte_letters().items()}
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[letters[b] + suffix] for b in range(256)], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        rank_of = {a + b: r for r, (a, b) in enumerate(pairs)}
        if len(vocab) > 65536 or any(max(rank_of.get(a, -1), rank_of.get(b, -1)) >= r for r, (a, b) in enumerate(pairs)):
            raise ValueError("not an ordered list of merges")
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.never = len(pairs)
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.uint64)
        self.tables, ranks = [], np.arange(len(pairs))
        while len(keys):  # keys that share a slot go on to the next table
            slot = self._slot(keys)
            _, first = np.unique(slot, return_index=True)
            key_at, rank_at = np.full(1 << 20, 2**40, np.uint64), np.full(1 << 20, self.never, np.int64)
            key_at[slot[first]], rank_at[slot[first]] = keys[first], ranks[first]
            self.tables.append((key_at, rank_at))
            rest = np.setdiff1d(np.arange(len(keys)), first)
            keys, ranks = keys[rest], ranks[rest]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        odd = np.uint64(0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * len(self.tables) & 0xFFFFFFFFFFFFFFFF | 1)
        return (keys * odd) >> np.uint64(44)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = (a << 16 | b).astype(np.uint64)
        tables, out = self.tables, np.full(len(keys), self.never, np.int64)
        for k, (key_at, rank_at) in enumerate(tables):
            odd = np.uint64(0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * k & 0xFFFFFFFFFFFFFFFF | 1)
            slot = (keys * odd) >> np.uint64(44)
            np.copyto(out, rank_at[slot], where=key_at[slot] == keys)
        return out

    def encode(self, strings: list[str]) -> list[bytes]:
        raw = [x.encode() for x in strings]
        size = np.array([len(x) for x in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.inner[flat]
        ends = np.cumsum(size) - 1
        sym[ends] = self.last[flat[ends]]
        word = np.repeat(np.arange(len(raw)), size)
        rank = np.full(len(sym), self.never, np.int64)
        same = word[1:] == word[:-1]
        rank[:-1][same] = self._rank(sym[:-1][same], sym[1:][same])
        out_sym, out_word = [], []
        while len(sym):
            heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            count = np.diff(np.r_[heads, len(sym)])
            best = np.minimum.reduceat(rank, heads)
            busy = np.repeat(best < self.never, count)
            if not busy.all():
                out_sym.append(sym[~busy])
                out_word.append(word[~busy])
                best, count = best[best < self.never], count[best < self.never]
                sym, word, rank = sym[busy], word[busy], rank[busy]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == np.repeat(best, count))
            at = at[np.r_[True, word[at[1:]] != word[at[:-1]]]]
            sym[at] = self.result[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, word, rank = sym[keep], word[keep], rank[keep]
            at -= np.arange(len(at))
            for left in (at[at + 1 < len(sym)], at[at > 0] - 1):
                joined = word[left] == word[left + 1]
                rank[left] = self.never
                left = left[joined]
                rank[left] = self._rank(sym[left], sym[left + 1])
            if at[-1] + 1 == len(sym):
                rank[at[-1]] = self.never
        word = np.concatenate(out_word)
        order = np.argsort(word, kind="stable")
        ids = np.concatenate(out_sym)[order].astype("<u4").tobytes()
        stop = 4 * np.cumsum(np.bincount(word, minlength=len(raw)))
        return [ids[a:b] for a, b in zip([0, *stop[:-1].tolist()], stop.tolist(), strict=True)]


class Encoder:
    """Encodes texts as the library does. `ids(text)` gives little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self.specials = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.merger = Merger(spec["model"]["vocab"], spec["model"]["merges"], self.suffix)
        self.whole = self.whole_tokens(spec["model"]["vocab"])
        self.memory: dict[bytes, bytes] = {}

    def whole_tokens(self, vocab: dict[str, int]) -> dict[str, bytes]:
        """Pre-tokens proved to encode alone as one token, with that id packed. On the way the array
        merges are held against the library on every vocabulary string."""
        letters, texts = _byte_letters(), []
        for token in vocab:
            try:
                text = bytes(letters[c] for c in token.removesuffix(self.suffix)).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if text and PLAIN.fullmatch(text) and PRETOKEN.fullmatch(text) and text == text.lower():
                texts.append(text)
        texts = list(dict.fromkeys(texts))
        proof = [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]
        if proof != self.merger.encode(texts):
            raise ValueError("the merges do not give the library's tokens")
        return {t: i for t, i in zip(texts, proof, strict=True) if len(i) == 4}

    def forget(self) -> None:
        """Give the chunk memory back when a task ends; the worker may live on for long."""
        self.memory = {}
        release()

    def slow(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of texts, in order. Null texts are empty."""
        block: list[bytes] = []
        size = 0
        for t in texts:
            block.append((t or "").encode())
            size += len(block[-1])
            if size > 1_000_000:
                yield from self._block(block)
                block, size = [], 0
        yield from self._block(block)

    def _learn(self, chunks: list[bytes]) -> None:
        """Put the ids of chunks without white space into the memory."""
        texts = b"\n".join(chunks).decode().split("\n")
        if not PLAIN_TEXT.fullmatch("\n".join(texts)):
            odd = [not PLAIN.fullmatch(t) for t in texts]
            self.memory.update((c, self.slow(t)) for c, t, o in zip(chunks, texts, odd, strict=True) if o)
            chunks = [c for c, o in zip(chunks, odd, strict=True) if not o]
            texts = [t for t, o in zip(texts, odd, strict=True) if not o]
        parts = list(map(PRETOKEN.findall, "\n".join(texts).lower().split("\n"))) if texts else []
        rest = list(set().union(*parts).difference(self.whole))
        ids = self.whole | dict(zip(rest, self.merger.encode(rest), strict=True)) if rest else self.whole
        self.memory.update(zip(chunks, [ids[p[0]] if len(p) == 1 else b"".join([ids[x] for x in p]) for p in parts], strict=True))

    def _block(self, raws: list[bytes]) -> Iterator[bytes]:
        special = [any(x in r for x in self.specials) for r in raws]
        chunks = [() if s else r.split() for r, s in zip(raws, special, strict=True)]
        used = set().union(*chunks)
        new = used.difference(self.memory)
        if len(self.memory) + len(new) > MEMORY:  # a block is bounded, so it fits alone
            self.memory = {c: self.memory[c] for c in used.difference(new)}
        if new:
            gc.disable()  # many short-lived lists, none of them cyclic
            self._learn(list(new))
            gc.enable()
        get = self.memory.__getitem__
        for r, s, c in zip(raws, special, chunks, strict=True):
            yield self.slow(r.decode()) if s else b"".join(map(get, c))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    return Encoder(path)


def slices(batch: pa.RecordBatch, column: str, most: int = 2_000_000) -> Iterator[tuple[int, list]]:
    """(first row, texts) of parts of a batch with a bounded number of characters."""
    part, size, start = [], 0, 0
    for i, x in enumerate(batch.column(column)):
        text = x.as_py()
        part.append(text)
        size += len(text or "")
        if size >= most:
            yield start, part
            part, size, start = [], 0, i + 1
    if part:
        yield start, part


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) for every row of `docs`.

    A null text is empty: 0 bytes, 0 tokens. Repeated rows each get a row; other columns are ignored.
    `path` is the vocabulary file, present on every executor; no special tokens are added.
    """

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            for start, texts in slices(batch, "text"):
                n_bytes = [len((t or "").encode()) for t in texts]
                n = [len(ids) // 4 for ids in enc.encode(texts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, len(texts)).cast(pa.int64()),
                        pa.array(n_bytes, pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array([x > limit for x in n], pa.bool_()),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )
        enc.forget()

    narrow = docs.selectExpr(f"`{doc_id}` AS doc_id", f"`{text}` AS text")
    return narrow.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids)
