"""Byte-level BPE encoding over shared prefixes of distinct words, and decoding."""

from __future__ import annotations

import hashlib
import json
from functools import cache
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import text_or_empty

#: The pre-tokenization pattern of this vocabulary
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: pre-tokens in one of the two generations that each worker remembers
REMEMBERED = 100_000
#: characters of text that are encoded together
SLICE = 1 << 20
NEVER = 1 << 60
#: token pairs that each worker remembers before it starts anew
PAIRS = 300_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


class PrefixEncoder:
    """Encodes words by the last token of each of their prefixes.

    The encoding of a prefix is that of a shorter prefix plus one last token. Among the tokens that end
    the prefix exactly one fits: the one that byte-pair merging leaves apart from the last token of
    the prefix before it. So one state for each node of a trie of words holds all encodings, and a
    shared prefix is computed once. The trie is walked depth first: in sorted order of the words, the
    path from the root is all that has to be kept.
    """

    def __init__(self, path: str):
        model = json.loads(open(path, encoding="utf-8").read())
        alphabet = byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.bytes_of = {i: raw(s) for s, i in model["model"]["vocab"].items() if s not in self.special}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.size_of = {i: len(b) for i, b in self.bytes_of.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        names = {i: b for i, b in self.bytes_of.items() if i not in self.special.values()}
        self.id_of = {b: i for i, b in names.items()}
        # every ending of a token with the token it is, or -1: endings of a path are followed from short to long
        self.endings = {b[i:]: -1 for b in self.id_of for i in range(1, len(b))} | self.id_of
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        #: the two parts of each token's last merge; where two merges give one token, merging its own bytes tells which
        self.parts: dict[bytes, tuple[bytes, bytes]] = {}
        twice = set()
        for a, b in self.rank:
            if self.parts.setdefault(a + b, (a, b)) != (a, b):
                twice.add(a + b)
        for t in twice:
            self.parts[t] = self.last_merge(t) or self.parts[t]
        #: piece -> ids, their decimal string and their bytes; the older generation goes when the newer one is full
        self.known: dict[str, tuple[tuple[int, ...], str, bytes]] = {}
        self.older: dict[str, tuple[tuple[int, ...], str, bytes]] = {}
        #: by (before << 20) + token, as whole numbers take less room than pairs
        self.pairs: dict[int, bool] = {}
        self.last_parts = cache(lambda i: self.edge(self.bytes_of[i], 1))
        self.first_parts = cache(lambda i: self.edge(self.bytes_of[i], 0))
        self.whole: dict[int, bool] = {}

    def merge(self, data: bytes, until: int = 1) -> list[bytes]:
        """Byte-pair merging by its definition, for short strings; stops at ``until`` parts."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > until:
            best = min((self.rank.get(p, NEVER), i) for i, p in enumerate(zip(parts, parts[1:])))
            if best[0] == NEVER:
                break
            pair = (parts[best[1]], parts[best[1] + 1])
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(pair[0] + pair[1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def last_merge(self, data: bytes) -> tuple[bytes, bytes] | None:
        parts = self.merge(data, 2)
        return (parts[0], parts[1]) if len(parts) == 2 and tuple(parts) in self.rank else None

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The parts that stand at one end of a token while it is merged, each with the rank of the merge that takes it up."""
        found, taken = [], NEVER
        while True:
            found.append((token, taken))
            if len(token) == 1:
                return found[::-1]
            parts = self.parts[token]
            taken, token = self.rank[parts], parts[side]

    def fits(self, before: int, token: int) -> bool:
        """Whether merging leaves the two tokens, written one after the other, as they are.

        Merges go by rank, so the parts on both sides of the border are followed upwards. A merge over the border comes
        first if its rank is below that of the merge that takes up the left part, and not above that
        of the right part, as of equal pairs the left one is merged first.
        """
        key = (before << 20) + token
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            left, right, rank = self.last_parts(before), self.first_parts(token), self.rank.get
            i = j = 0
            known = True
            while i < len(left) and j < len(right):
                (a, up_a), (b, up_b) = left[i], right[j]
                over = rank((a, b), NEVER)
                if over < up_a and over <= up_b:
                    known = False
                    break
                if up_a <= up_b:
                    i += 1
                else:
                    j += 1
            self.pairs[key] = known
        return known

    def alone(self, token: int) -> bool:
        """Whether merging reaches the token from its own bytes."""
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = len(self.merge(self.bytes_of[token])) == 1
        return known

    def last_token(self, word: bytes, end: int, last: list[int]) -> int:
        """The token that ends the first ``end`` bytes, where ``last[i]`` is the one that ends the first i."""
        endings, found, at = self.endings, [], end - 1
        while at >= 0:
            token = endings.get(word[at:end])
            if token is None:
                break
            if token >= 0:
                found.append((at, token))
            at -= 1
        for at, token in reversed(found):
            known = self.pairs.get((last[at] << 20) + token) if at else self.whole.get(token)
            if known or known is None and (self.fits(last[at], token) if at else self.alone(token)):
                return token
        raise ValueError(f"no token ends {word[:end]!r}")

    def encode_words(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, tuple[int, ...]]]:
        """(word, ids) of distinct words, in sorted order."""
        path, last, sizes = b"", [-1], self.size_of
        for word in sorted(words):
            same = 0
            for x, y in zip(path, word):
                if x != y:
                    break
                same += 1
            del last[same + 1:]
            for end in range(same + 1, len(word) + 1):
                last.append(self.last_token(word, end, last))
            path, ids, end = word, [], len(word)
            while end:
                ids.append(last[end])
                end -= sizes[last[end]]
            yield word, tuple(reversed(ids))

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of a text, which are encoded apart, special tokens among them."""
        if not self.special:
            return SPLIT.findall(text)
        return [p for x in self.cut_special.split(text) for p in ([x] if x in self.special else SPLIT.findall(x))]

    def remember(self, pieces: set[str]) -> None:
        """Encode the pre-tokens that are not known; each distinct one once."""
        if len(self.known) >= REMEMBERED:
            self.known, self.older = {}, self.known
        known, older, bytes_of = self.known, self.older, self.bytes_of
        new = {}
        for p in pieces - known.keys():
            kept = older.get(p)
            if kept:
                known[p] = kept
            elif p in self.special:
                known[p] = ((self.special[p],), str(self.special[p]), bytes_of[self.special[p]])
            else:
                new[p.encode()] = p
        for word, ids in self.encode_words(new):
            known[new[word]] = (ids, ",".join(map(str, ids)), b"".join([bytes_of[i] for i in ids]))

    def encode_texts(self, texts: list[str]) -> Iterator[list[tuple[tuple[int, ...], str, bytes]]]:
        """For each text what its pieces are encoded to: ids, their decimal string, their bytes."""
        cut = [self.cut(t) for t in texts]
        self.remember(set().union(*cut))
        for pieces in cut:
            yield [self.known[p] for p in pieces]


def decoded(coded: list[tuple[tuple[int, ...], str, bytes]]) -> str:
    """The text of the bytes of all ids."""
    return b"".join([x[2] for x in coded]).decode("utf-8", "replace")


_ENCODERS: dict[str, PrefixEncoder] = {}


def encoder(path: str) -> PrefixEncoder:
    """The encoder of a vocabulary file, loaded once in each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PrefixEncoder(path)
    return _ENCODERS[path]


def slices(column: pa.Array, most: int = SLICE) -> Iterator[list[str]]:
    """The texts of a batch in runs of about ``most`` characters."""
    run, held = [], 0
    for x in column:
        run.append(x.as_py())
        held += len(run[-1])
        if held > most:
            yield run
            run, held = [], 0
    yield run


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) and their decoded text, for every row; null text is empty.

    The work has no shuffle: each task encodes the distinct words of its batches. ``path`` is a
    tokenizers file of a byte-level BPE that every executor can open. Null doc_ids, repeated rows and rows that share a doc_id
    are encoded as rows of their own; an empty table gives no rows; other columns are not read, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text")):
                ids, back = [], []
                for coded in own.encode_texts(texts):
                    ids.append([i for x in coded for i in x[0]])
                    back.append(decoded(coded))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.string())], ["doc_id", "ids", "decoded"])
                at += len(texts)

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def token_digest(docs: DataFrame, path: str) -> DataFrame:
    """One row for each document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no token and the digests of the empty string. The strings of special
    tokens in a text become those tokens, as the tokenizers library reads them. Texts of any length
    are encoded whole. Repeated rows keep their number; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            n, ids, back = [], [], []
            for texts in slices(batch.column("text")):
                for coded in own.encode_texts(texts):
                    n.append(sum([len(x[0]) for x in coded]))
                    ids.append(sha(",".join([x[1] for x in coded])))
                    back.append(sha(decoded(coded)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
