"""BPE encoding and decoding with a pair occurrence index.

Words new to a task's batch are laid out in one flat symbol list.  An index
maps every mergeable adjacent pair to all its positions; active ranks are taken
in ascending order, each applied at all its positions (left to right), and only
the lists of the neighbouring pairs are updated.  Encoded words are kept in a
bounded table per Python worker, so a word is merged once while it stays there.

Defined results: a null text is the empty text and has no ids; strings of the
vocabulary's special tokens in a text become their ids; words of any length
are merged whole; repeated rows give repeated results; columns other than the
id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words kept per task; the table is emptied when full (results do not change).
WORD_TABLE = 200_000
# Longer words are merged each time they occur and not kept.
WORD_KEPT_CHARS = 48

# The split pattern of word-end vocabularies, and its equal for
# texts of ASCII and Latin-1 letters, which Python's own engine runs faster.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN_SPLIT = re.compile(r"[a-zß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
NOT_LATIN = re.compile(r"[^\t\n\r !-~À-ÖØ-öø-ÿ]")

SCHEMA = "id long, n_tokens long, ids_text string, decoded string"
DIGEST = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte used by byte-level vocabularies:
    printable Latin-1 stands for itself, the rest for code points from 256."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 256
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class WordBpe:
    """A word-end BPE vocabulary read from a ``tokenizers`` JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        self.token = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token.update({i: t for t, i in self.special.items()})
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a], vocab[b]] = r
            self.made.append(vocab[a + b])
        alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in alphabet]
        self.last = [vocab[c + self.suffix] for c in alphabet]
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split, regex.V0)
        self.latin = split == SPLIT
        self.pair_of = {r: p for p, r in self.rank.items()}
        self.table: dict[str, tuple[int, str, str]] = {}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def normal(self, text: str) -> str:
        # Lower case is taken per character: no context rule for a final sigma.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pieces(self, text: str) -> list[str]:
        """Words of a text in order; special tokens stand as themselves."""
        if "<|" not in text:
            plain = self.normal(text)
            if self.latin and NOT_LATIN.search(plain) is None:
                return LATIN_SPLIT.findall(plain)
            return self.words.findall(plain)
        out: list[str] = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out += self.words.findall(self.normal(part))
        return out

    def merge(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word, through one pair occurrence index."""
        sym: list[int] = []
        nxt: list[int] = []
        prv: list[int] = []
        starts: list[int] = []
        rank, made = self.rank, self.made
        at: dict[int, list[int]] = {}
        for w in words:
            raw = w.encode("utf-8", "replace")
            base = len(sym)
            starts.append(base)
            sym += [self.inner[b] for b in raw[:-1]]
            sym.append(self.last[raw[-1]])
            end = len(sym)
            prv += range(base - 1, end - 1)
            nxt += range(base + 1, end + 1)
            prv[base], nxt[end - 1] = -1, -1
            for i in range(base, end - 1):
                r = rank.get((sym[i], sym[i + 1]))
                if r is not None:
                    at.setdefault(r, []).append(i)
        pair_of = self.pair_of
        active = list(at)
        heapify(active)
        while active:
            r = heappop(active)
            spots = at.pop(r, None)
            if not spots:
                continue
            a, b = pair_of[r]
            new = made[r]
            spots.sort()
            for i in spots:
                j = nxt[i]
                if sym[i] != a or j < 0 or sym[j] != b:
                    continue
                sym[i], sym[j] = new, -1
                k = nxt[i] = nxt[j]
                if k >= 0:
                    prv[k] = i
                    q = rank.get((new, sym[k]))
                    if q is not None:
                        if q not in at:
                            at[q] = []
                            heappush(active, q)
                        at[q].append(i)
                p = prv[i]
                if p >= 0:
                    q = rank.get((sym[p], new))
                    if q is not None:
                        if q not in at:
                            at[q] = []
                            heappush(active, q)
                        at[q].append(p)
        out = []
        for s in starts:
            ids, i = [], s
            while i >= 0:
                ids.append(sym[i])
                i = nxt[i]
            out.append(ids)
        return out

    def encode_many(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """(number of ids, ids joined by spaces, decoded text) of each text."""
        token, special, table = self.token, self.special, self.table
        docs = [self.pieces(t) for t in texts]
        fresh = {w for d in docs for w in d if w not in table and w not in special}
        if len(table) + len(fresh) > WORD_TABLE:
            table.clear()
            fresh = {w for d in docs for w in d if w not in special}
        local = {s: (1, str(i), s) for s, i in special.items()}
        order = sorted(fresh)
        for w, ids in zip(order, self.merge(order)):
            entry = (len(ids), " ".join(map(str, ids)), " ".join([token[i] for i in ids]))
            (table if len(w) <= WORD_KEPT_CHARS else local)[w] = entry
        for d in docs:
            found = [table.get(w) or local[w] for w in d]
            yield sum(e[0] for e in found), " ".join([e[1] for e in found]), " ".join([e[2] for e in found])


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def _run(path: str, digest: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from wellspark.llm.common import slices

        bpe = load(path)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for lo, hi in slices(map(len, texts), 2_000_000):
                rows = list(bpe.encode_many(texts[lo:hi]))
                ids, dec = [r[1] for r in rows], [r[2] for r in rows]
                if digest:
                    ids = [hashlib.sha256(s.encode()).hexdigest() for s in ids]
                    dec = [hashlib.sha256(s.encode("utf-8")).hexdigest() for s in dec]
                names = ("ids_sha256", "decoded_sha256") if digest else ("ids_text", "decoded")
                yield pd.DataFrame({"id": batch["id"].iloc[lo:hi].astype("Int64").values, "n_tokens": [r[0] for r in rows],
                                    names[0]: ids, names[1]: dec})
    return run


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           digest: bool = False) -> DataFrame:
    """One row per document: the id, ``n_tokens`` and either the ids (array) and
    the decoded text, or their SHA-256 digests.  No shuffle: each scan task
    encodes its own rows; ``vocabulary`` must be readable on every executor."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = src.mapInPandas(_run(vocabulary, digest), DIGEST if digest else SCHEMA)
    if not digest:
        ids = F.when(F.col("ids_text") == "", F.array().cast("array<int>")).otherwise(
            F.split("ids_text", " ").cast("array<int>"))
        out = out.select("id", "n_tokens", ids.alias("ids"), "decoded")
    return out.withColumnRenamed("id", id_col)
