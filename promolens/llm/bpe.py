"""BPE encoding and decoding as a bounded-lookahead streaming transducer."""

from __future__ import annotations

import hashlib
import json
from functools import cache
from itertools import chain

import regex
from pyspark.sql import DataFrame

from promolens.llm.common import doc_texts, map_rows

MODEL = "word_bpe_49k.json"
#: Words a worker remembers (twice as many at most), the longest one it remembers, and the characters encoded at once.
CACHED, LONGEST, SLICE = 400_000, 64, 1 << 16
#: White space that every view of Unicode agrees on, what stands between, and characters that Python alone takes for blanks.
_BLANK, _WORD, _ODD_BLANK = regex.compile(r"[ \t\n\r]"), regex.compile(r"[^ \t\n\r]+"), regex.compile(r"[\x1c-\x1f]")
#: A sign before a letter: a place where a long word may be cut.
_CUT = regex.compile(r"[,.;:!?。，、！？；：](?=[a-zA-Z一-鿿ぁ-ヿ])")
#: Characters whose normal form and class are the same for every Unicode version at hand.
_PLAIN = regex.compile(r"[^\t\n\r\x20-\x7e¡-įı-ǃǍ-ȗ]")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable letter for each byte: itself where printable, else the next from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Transducer:
    """The model's merge list as a transducer over the units of one pre-token.

    The encoding of a text passes through the encodings of its own prefixes: cut at any of its
    token boundaries, the part before is that prefix's encoding. So one token is kept for each
    prefix, its last; it is the one that ends there and may stand behind the last token of the
    prefix before it. No token is longer than ``lookahead`` units, hence whatever follows, the
    final encoding has a boundary among the last ``lookahead`` prefixes, and tokens that all of
    these share are stable and can be emitted.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {v: k for k, v in (self.ids | self.special).items()}
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: k for k, pair in reversed(list(enumerate(pairs)))}
        self.letters = byte_letters()
        self._fits: dict[tuple[str, str], bool] = {}
        self.reachable = {t: self.merge(self.units(t)) == [t] for t in self.ids}
        self.lookahead = max(len(self.units(t)) for t, ok in self.reachable.items() if ok)
        self.backwards: dict = {}  # a trie of reachable tokens from their last unit on; None leads to the token itself
        for token, ok in self.reachable.items():
            if ok:
                node = self.backwards
                for unit in reversed(self.units(token)):
                    node = node.setdefault(unit, {})
                node[None] = token

    def units(self, token: str) -> list[str]:
        """The single units of a token; the last one carries the end of the word."""
        if self.end and token.endswith(self.end) and token != self.end:
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def merge(self, units: list[str]) -> list[str]:
        """Plain merging by rank, leftmost first: for pairs, short pre-tokens and the proof."""
        units, get, none = list(units), self.ranks.get, 1 << 60
        ranks = [get(p, none) for p in zip(units, units[1:], strict=False)]
        while ranks and (rank := min(ranks)) != none:
            k = ranks.index(rank)
            a, b = units[k], units[k + 1]
            both = a + b
            while True:  # all places of this pair, from the left
                units[k : k + 2] = [both]
                del ranks[k]
                if k:
                    ranks[k - 1] = get((units[k - 1], both), none)
                if k == len(ranks):
                    break
                ranks[k] = get((both, units[k + 1]), none)
                k += 1
                while k < len(ranks) and not (ranks[k] == rank and units[k] == a and units[k + 1] == b):
                    k += 1
                if k >= len(ranks):
                    break
        return units

    def fits(self, left: str, right: str) -> bool:
        """Does the pair stay a pair when its own units are merged?"""
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) >= CACHED:
                self._fits.clear()
            known = self._fits[left, right] = self.merge(self.units(left) + self.units(right)) == [left, right]
        return known

    def stream(self, units):
        """Tokens of an iterable of units, each as soon as it is stable; memory is a constant."""
        reach, trie, fits = self.lookahead, self.backwards, self._fits
        held: list[str] = []  # units that no token has been emitted for
        last: list[tuple[str, int]] = []  # for each prefix that ends there: its last token and that token's length
        for unit in units:
            held.append(unit)
            # the tokens that end here, shortest first, in one walk backwards
            node, k, found = trie, len(held), []
            while k and (node := node.get(held[k - 1])):
                k -= 1
                if None in node:
                    found.append((node[None], k))
            best = (unit, 1)
            for token, k in reversed(found):
                if not k:
                    best = (token, len(held))
                    break
                pair = (last[k - 1][0], token)
                if fits[pair] if pair in fits else self.fits(*pair):
                    best = (token, len(held) - k)
                    break
            last.append(best)
            if len(held) >= 8 * reach:  # emit what the last `reach` prefixes share
                cut = self._shared(last, reach)
                if cut:
                    yield from self._tokens(last, cut)
                    del held[:cut], last[:cut]
        yield from self._tokens(last, len(last))

    def _shared(self, last, reach: int) -> int:
        """The last prefix that all of the last ``reach`` ones go through: each leads to one before it, so the highest is led on until one is left."""
        some = set(range(len(last) - reach + 1, len(last) + 1))
        for end in range(len(last), 0, -1):
            if end in some:
                if len(some) == 1:
                    return end
                some.remove(end)
                some.add(end - last[end - 1][1])
        return 0

    def _path(self, last, end: int):
        while end > 0:
            yield end
            end -= last[end - 1][1]

    def _tokens(self, last, end: int) -> list[str]:
        return [last[k - 1][0] for k in self._path(last, end)][::-1]

    def encode_pretoken(self, pretoken: str):
        """Tokens of a pre-token, streamed if it is longer than the lookahead; units are letters of bytes, the last with the word end."""
        letters, raw = self.letters, pretoken.encode()
        if len(raw) <= self.lookahead:  # its end comes before any token could be emitted
            units = [letters[b] for b in raw]
            units[-1] += self.end
            return [t for t in self.merge(units) if t in self.ids]
        units = (letters[b] if k < len(raw) - 1 else letters[b] + self.end for k, b in enumerate(raw))
        return (t for t in self.stream(units) if t in self.ids)


class _Known(dict):
    """Ids, as little-endian bytes, of words and pre-tokens that a worker has encoded.

    When it is full, its entries become the older ones, which are forgotten the next time unless
    they are asked for.
    """

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = b"".join(self.make(word))
        if len(word) <= LONGEST:
            if len(self) >= CACHED:
                self.older = self.copy()
                self.clear()
            self[word] = found
        return found


class Codec:
    """Whole texts to ids, a slice at a time; no more than a slice and its ids are held.

    White space ends pre-tokens and is left out by the model, so words are encoded one by one. A
    word that is longer than a slice goes through the transducer as its units come.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)  # its normaliser and splitter, for words with rare characters
        self.machine = Transducer(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.split = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.machine.special)) + ")") if self.machine.special else None
        self.table = byte_table(self.machine)
        self.known, self.lettered = _Known(self._word), _Known(lambda piece: map(self._id, self._lettered(piece)))

    def _id(self, token: str) -> bytes:
        return self.machine.ids[token].to_bytes(4, "little")

    def _word(self, word: str):
        """Ids, bytes by bytes, of a word that holds no white space."""
        if not _PLAIN.search(word):
            for m in self.split.finditer(word.lower()):
                pretoken = m[0]
                if pretoken == word or len(pretoken) > LONGEST:
                    yield from map(self._id, self.machine.encode_pretoken(pretoken))
                else:
                    yield self.known[pretoken]
            return
        at = 0
        for end in chain((m.end() for m in _CUT.finditer(word, SLICE)), (len(word),)):
            if end - at >= SLICE or end == len(word):  # between a sign and a letter neither normal forms nor pre-tokens reach across
                for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(word[at:end])):
                    if len(piece) <= LONGEST:
                        yield self.lettered[piece]
                    else:
                        yield from map(self._id, self._lettered(piece))
                at = end

    def _lettered(self, piece: str):
        """Tokens of a pre-token that the library has already written in letters of bytes."""
        units = (c if k < len(piece) - 1 else c + self.machine.end for k, c in enumerate(piece))
        return (t for t in self.machine.stream(units) if t in self.machine.ids)

    def _slice(self, part: str):
        if len(part) > 2 * SLICE:
            for m in _WORD.finditer(part):
                yield from self._word(m[0])
        else:
            yield b"".join(map(self.known.__getitem__, _WORD.findall(part) if _ODD_BLANK.search(part) else part.split()))

    def encode(self, text: str):
        """Ids as bytes, some at a time; special strings are their own token."""
        at, n = 0, len(text)
        while at < n:
            m = _BLANK.search(text, at + SLICE) if at + SLICE < n else None
            end = m.start() if m else n
            part = text[at:end]
            at = end
            if self.specials and "<|" in part:
                for k, some in enumerate(self.specials.split(part)):
                    if k % 2:
                        yield self.machine.special[some].to_bytes(4, "little")
                    elif some:
                        yield from self._slice(some)
            else:
                yield from self._slice(part)


class Decoder:
    """Incremental state machine from ids to text, as the model without a decoder writes it: tokens, blanks between."""

    def __init__(self, names: dict[int, str]):
        self.names, self.begun = names, False

    def feed(self, ids) -> str:
        try:
            out = " ".join(map(self.names.__getitem__, ids))
        except KeyError:  # an id that stands for nothing
            out = " ".join(self.names[i] for i in ids if i in self.names)
        if out and self.begun:
            out = " " + out
        self.begun |= bool(out)
        return out


class ByteDecoder:
    """State machine from ids to the text they stand for: bytes of a character are held until it is whole.

    A word's end is a blank; bytes that are no UTF-8 become replacement characters.
    """

    def __init__(self, table: dict[int, bytes]):
        import codecs

        self.table, self.held = table, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids, last: bool = False) -> str:
        return self.held.decode(b"".join([self.table[i] for i in ids if i in self.table]), last)


def byte_table(machine: Transducer) -> dict[int, bytes]:
    """The bytes of each id's token, a blank for the end of a word; special strings as they are."""
    of, out = {c: b for b, c in enumerate(byte_letters())}, {}
    for token, k in machine.ids.items():
        body = token[: -len(machine.end)] if machine.end and token.endswith(machine.end) else token
        out[k] = bytes(of[c] for c in body) + b" " * (body != token) if all(c in of for c in body) else token.encode()
    return out | {k: token.encode() for token, k in machine.special.items()}


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def _blocks(parts):
    """Some bytes at a time, joined to blocks of a slice or more."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part)
        if n >= SLICE:
            yield b"".join(held)
            held, n = [], 0
    if n:
        yield b"".join(held)


def code_documents(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Operator: the ids of each whole text (if asked for), their number and digest, and digests of what they decode to.

    decoded_sha256 is of the model's own decoding, tokens with blanks between; text_sha256 of the
    text that the tokens' bytes stand for. Ids go to the digests in blocks, so a huge text needs
    no list of its tokens unless its ids are asked for. Both decoders are fed the ids of each
    block, as they went to their digest, and nothing else. Pre-tokens no longer than the lookahead
    end before a token could be emitted, and are merged at once. Null and empty texts have no ids
    and decode to nothing; repeated rows are encoded each; an empty table gives no rows.
    """
    path = path or model_path()

    def run(rows):
        import numpy as np

        one, out = codec(path), {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256", "text_sha256", "ids")}
        for text in rows["text"]:
            hashes, n, decoder, bytewise, kept = [hashlib.sha256() for _ in range(3)], 0, Decoder(one.machine.names), ByteDecoder(one.table), []
            for block in _blocks(one.encode(text)):
                ids = np.frombuffer(block, "<u4")
                n += ids.size
                if with_ids:
                    kept.append(ids)
                emitted = ids.tolist()
                for h, part in zip(hashes, (block, decoder.feed(emitted).encode(), bytewise.feed(emitted).encode()), strict=True):
                    h.update(part)
            hashes[2].update(bytewise.feed((), True).encode())
            for k, v in zip(out, (n, *(h.hexdigest() for h in hashes)), strict=False):
                out[k].append(v)
            if with_ids:
                out["ids"].append(np.concatenate(kept).astype("i4") if kept else np.zeros(0, "i4"))
        return {"doc_id": rows["doc_id"]} | out

    return map_rows(doc_texts(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, text_sha256 string" + ", ids array<int>" * with_ids)


def digest_encoding(docs: DataFrame, path: str | None = None) -> DataFrame:
    """code_documents without the ids themselves."""
    return code_documents(docs, path, with_ids=False)
