"""Byte-level BPE: whole texts to ids and back, with long texts encoded in parallel.

Ids are kept as bytes, four per id, little-endian. A short text is encoded where it is.
A long text is cut into halves, again and again, whose ends are encoded by different
tasks; joined halves agree with the encoding of the whole text because

* a split of the pre-tokenizer depends on nothing before it and on at most two characters
  after it, so around a join splits are redone from the last sure split on the left until
  one falls on a split of the right side, and
* inside one unsplit word a token sequence is the encoding if each two neighbours are, so
  a window around the join grows until its first and last token are the ones already there.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tideline.llm.shared import small_batches

#: Texts of more characters than LONG are cut until no piece has more than LEAF.
LONG, LEAF = 32_768, 16_384
#: Characters after a split that can decide it.
AHEAD = 2

# Fixed: the splits of byte-level pre-tokenization.
SPLITS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, others from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """A tokenizer file, with a faster encoder of the same ids where its kind allows one."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.fast = self._ranked(spec)

    @cached_property
    def tokenizer(self):
        """The file as its library reads it; loaded only where it is needed, for its size."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.path)
        found.no_truncation()
        found.no_padding()
        return found

    def _ranked(self, spec: dict):
        """An encoder by ranks, if the file is plain byte-level BPE whose ids follow its merges."""
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (
            model.get("type") == "BPE"
            and not spec.get("normalizer")
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and not any(t[k] for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip"))
        )
        if not plain:
            return None
        vocab = {k: v for k, v in model["vocab"].items() if v not in self.specials.values()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(vocab.get("".join(p)) != 256 + i for i, p in enumerate(pairs)) or len(vocab) != 256 + len(pairs):
            return None
        import tiktoken

        self.byte_of = byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in token): rank for token, rank in vocab.items()}
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.sizes = np.zeros(max([*ranks.values(), *self.specials.values()]) + 1, dtype=np.int64)
        self.spaced = np.zeros(len(self.sizes), dtype=bool)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)
            self.spaced[rank] = len(token) > 1 and token[0] == 32 and 32 < token[1] < 127
        return tiktoken.Encoding("plain", pat_str=SPLITS, mergeable_ranks=ranks, special_tokens=self.specials)

    def encode(self, text: str) -> np.ndarray:
        if self.fast:
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        if self.fast:
            return self.fast.decode(ids.tolist(), errors="replace")
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)

    def sections(self, text: str) -> Iterator[str]:
        """Pieces between special tokens, and those tokens; nothing is encoded across them."""
        import regex

        if not self.specials:
            yield text
            return
        longest_first = sorted(self.specials, key=len, reverse=True)
        pattern = "(" + "|".join(map(regex.escape, longest_first)) + ")"
        yield from (part for part in regex.split(pattern, text) if part)

    def splits(self, text: str) -> list[tuple[str, int, int]]:
        """Words of the pre-tokenizer as (byte-level word, start, end); places count bytes."""
        out, at = [], 0
        for word, _ in self.splitter.pre_tokenize_str(text):
            out.append((word, at, at + len(word)))
            at += len(word)
        return out

    @cached_property
    def splitter(self):
        from tokenizers.pre_tokenizers import ByteLevel

        return ByteLevel(add_prefix_space=False, use_regex=True)

    def whole_word(self, word: str) -> list[int]:
        """Ids of one word of the pre-tokenizer; by itself it is one word again."""
        return self.fast.encode_ordinary(bytes(map(self.byte_of.get, word)).decode())

    def word(self, word: str) -> list[int]:
        """Ids of any bytes taken as one word."""
        return [token.id for token in self.tokenizer.model.tokenize(word)]

    def starts(self, ids: np.ndarray) -> np.ndarray:
        """Places in ``ids`` where a word starts for sure, the first included.

        A space before a printable character is only ever the start of a word. Texts without
        such spaces are split to find all starts.
        """
        found = np.flatnonzero(self.spaced[ids])
        if len(found) < 2:
            ends = np.cumsum(self.sizes[ids])
            bounds = [start for _, start, _ in self.splits(self.raw(ids).decode())]
            found = np.flatnonzero(np.isin(ends - self.sizes[ids], bounds))
        return found if len(found) and found[0] == 0 else np.concatenate([[0], found])

    def raw(self, ids: np.ndarray) -> bytes:
        return b"".join(self.bytes_of[i] for i in ids.tolist())

    def _inside(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of one word from the ids of its two parts."""
        char = {b: c for c, b in _byte_of_char().items()}
        i = j = 1
        while True:
            a, b = left[max(0, len(left) - i) :], right[:j]
            window = self.word("".join(char[x] for x in self.raw(a) + self.raw(b)))
            sure_left = i >= len(left) or window[0] == a[0]
            sure_right = j >= len(right) or window[-1] == b[-1]
            if sure_left and sure_right:
                return np.concatenate([left[: len(left) - len(a)], np.array(window, "<u4"), right[len(b) :]])
            i, j = (i if sure_left else 2 * i), (j if sure_right else 2 * j)

    def _one_word(self, ids: np.ndarray) -> bool:
        return len(self.splits(self.raw(ids).decode())) == 1

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of two neighbouring pieces put together."""
        if not len(left) or not len(right):
            return left if len(left) else right
        words = self.starts(left)
        n = len(words) - 1
        while n > 0 and len(self.raw(left[words[n] :]).decode()) < AHEAD:
            n -= 1
        sure = int(words[n])
        before = self.raw(left[sure:])
        ends = [*self.starts(right)[1:].tolist(), len(right)]
        many = 2
        while True:
            taken = ends[:many]
            after = self.raw(right[: taken[-1]])
            found = self.splits((before + after).decode())
            places = {end for _, _, end in found}
            bounds = np.cumsum(self.sizes[right[: taken[-1]]])[np.array(taken) - 1].tolist()
            whole = taken[-1] == len(right)
            spare = len(after) if whole else len(after) - len(after.decode()[-AHEAD:].encode())
            met = next((k for k, q in enumerate(bounds) if q <= spare and len(before) + q in places), None)
            if met is not None:
                break
            many *= 2
        until, last = len(before) + bounds[met], taken[met]
        parts = [left[:sure]]
        for word, start, end in found:
            if end > until:
                break
            first = (start, end) == (0, len(before) + bounds[0])
            if first and self._one_word(left[sure:]) and self._one_word(right[: taken[0]]):
                parts.append(self._inside(left[sure:], right[: taken[0]]))
            else:
                parts.append(np.array(self.whole_word(word), dtype="<u4"))
        return np.concatenate([*parts, right[last:]])

    def joined(self, pieces: list[np.ndarray]) -> np.ndarray:
        """Neighbours are joined pair by pair, then the pairs, up to the whole."""
        while len(pieces) > 1:
            pairs = [self.join(*pieces[i : i + 2]) for i in range(0, len(pieces) - 1, 2)]
            pieces = pairs + pieces[2 * len(pairs) :]
        return pieces[0] if pieces else np.zeros(0, "<u4")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def halves(text: str, most: int) -> list[str]:
    """The text cut in halves until no piece has more than ``most`` characters."""
    if len(text) <= most:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], most) + halves(text[middle:], most)


def encode_documents(
    docs: DataFrame,
    path: str,
    text: str = "text",
    doc_id: str = "doc_id",
    long: int = LONG,
    leaf: int = LEAF,
) -> DataFrame:
    """``doc_id`` and ``ids`` (binary) for every row; a null text is empty and has no ids.

    Equal to what the tokenizer of the file at ``path`` (on every node) gives for the whole
    text without added special tokens. Repeated rows stay repeated.
    """
    small_batches(docs.sparkSession)
    words = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), words.alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    @F.pandas_udf("binary")
    def encoded(batch: pd.Series) -> pd.Series:
        own = codec(path)
        return batch.map(lambda value: own.encode(value).tobytes())

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, seen, part = codec(path), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            for row_id, value in zip(batch["doc_id"], batch["text"], strict=True):
                name = f"{row_id}:{hashlib.sha256(value.encode()).hexdigest()}"
                seen[name] += 1  # rows that are alike may swap their numbers, nothing else
                key, out = f"{name}:{part}:{seen[name]}", []
                sections = own.sections(value) if own.fast else [value]
                for s, section in enumerate(sections):
                    alone = section in own.specials or not own.fast
                    pieces = [section] if alone else halves(section, leaf)
                    out += [(row_id, key, s, p, piece) for p, piece in enumerate(pieces)]
                frame = pd.DataFrame(out, columns=["doc_id", "key", "section", "piece", "text"])
                yield frame.astype({"doc_id": batch["doc_id"].dtype})

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path)
        for batch in batches:
            yield batch.drop(columns="text").assign(ids=[own.encode(t).tobytes() for t in batch["text"]])

    def whole(pieces: pd.DataFrame) -> pd.DataFrame:
        own = codec(path)
        pieces = pieces.sort_values(["section", "piece"])
        done = []
        for _, section in pieces.groupby("section", sort=True):
            parts = [np.frombuffer(ids, "<u4") for ids in section["ids"]]
            done.append((own.joined(parts) if len(parts) > 1 else parts[0]).tobytes())
        return pieces.head(1)[["doc_id"]].assign(ids=[b"".join(done)])

    is_long = F.length("text") > long
    short = rows.where(~is_long).select("doc_id", encoded("text").alias("ids"))
    shape = f"doc_id {kind}, key string, section int, piece int"
    tree = (
        rows.where(is_long)
        .mapInPandas(cut, f"{shape}, text string")
        .repartition("key", "section", "piece")
        .mapInPandas(leaves, f"{shape}, ids binary")
        .groupBy("key")
        .applyInPandas(whole, f"doc_id {kind}, ids binary")
    )
    return short.unionByName(tree)


def decoded(ids: Column, path: str) -> Column:
    """The text that ids stand for, special tokens included."""

    @F.pandas_udf("string")
    def run(batch: pd.Series) -> pd.Series:
        own = codec(path)
        return batch.map(lambda value: own.decode(np.frombuffer(value, "<u4")))

    return run(ids)


def round_trip_report(docs: DataFrame, path: str) -> DataFrame:
    """Token counts and digests of ids and of decoded texts for whole documents."""
    ids = encode_documents(docs, path)
    return ids.select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(decoded(F.col("ids"), path).cast("binary"), 256).alias("decoded_sha256"),
    )
