"""Token counts of a sentence-piece BPE model, by stable boundaries and overlap resynchronisation."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from functools import cache

from pyspark.sql import DataFrame

from promolens.llm.common import doc_texts, map_rows

MODEL, LIMIT = "piece_bpe_32k.model", 4096
#: Texts above CHUNK characters are encoded in chunks that overlap by OVERLAP at first.
CHUNK, OVERLAP = 16384, 256
#: Segments whose counts a worker remembers.
CACHED = 400_000
_SEGMENT = re.compile(" +[^ ]*")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Counts(dict):
    """Tokens of a segment without its first blank, which the model puts there itself."""

    def __init__(self, model):
        super().__init__()
        self.model, self.blank = model, len(model.encode("a ")) - len(model.encode("a"))

    def __missing__(self, segment: str) -> int:
        if len(self) >= CACHED:
            self.clear()
        n = self[segment] = len(self.model.encode(segment)) if segment else self.blank
        return n


class PieceCounter:
    """Counts tokens of whole texts as the model does, on less than whole texts at a time.

    Two characters that stand side by side in no piece of the vocabulary have a stable boundary
    between them: no merge can reach across it. Blanks behind other characters are such places, if
    the constructor finds none in the vocabulary, and so are most pairs of rare characters. The
    constructor also probes that the model keeps characters as they are and falls back on bytes
    for those it doesn't know; a model that fails gets every text whole.
    """

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap, self.widened = chunk, overlap, 0
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        kept = "".join(self.model.encode("  a  b ", out_type=str)) == "▁▁▁a▁▁b▁"
        rare = "ａ\u0301\ufb01\u200b\U0001f9ff"  # what a normaliser would change, and what no vocabulary holds
        kept = kept and b"".join(bytes([int(p[3:5], 16)]) if p.startswith("<0x") else p.replace("▁", "").encode() for p in self.model.encode(rare, out_type=str)) == rare.encode()
        self.stable = kept and not any("▁" in p.lstrip("▁") for p in pieces)
        self.pairs = {p[k : k + 2].replace("▁", " ") for p in pieces for k in range(len(p) - 1)}
        self.known = _Counts(self.model)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.stable:
            return len(self.model.encode(text))
        text = text.replace("▁", " ")  # the model itself writes a blank like this
        if len(text) > self.chunk:
            return self._spliced(text)
        if "  " in text or text[0] == " " or text[-1] == " ":
            return sum(self.known[s[1:]] for s in _SEGMENT.findall(" " + text))
        return sum(map(self.known.__getitem__, text.split(" ")))

    def _starts(self, text: str, start: int, stop: int) -> list[int]:
        """Where the tokens of text[start:stop] begin, by the offsets the model reports."""
        skip = int(start > 0 and text[start] == " ")
        out = [start + skip + a for a, _ in self.model.encode(text[start + skip : stop], return_type="offset_mapping")["offsets"]]
        if skip and out:
            out[0] = start
        return out

    def _spliced(self, text: str) -> int:
        """Encode overlapping chunks and splice where both have a token boundary at a stable place.

        Behind such a place the later chunk's tokens are the text's, before it the earlier
        one's. An overlap without one is doubled, back to the last splice at worst; then the
        later chunk holds all that is open and replaces the earlier one.
        """
        n, done, stop = 0, 0, self.chunk
        tokens = self._starts(text, 0, stop)
        while stop < len(text):
            overlap = self.overlap
            while True:
                begin = max(done, stop - overlap)
                end = min(len(text), begin + 2 * overlap + self.chunk)
                following = self._starts(text, begin, end)
                both = set(tokens[bisect_right(tokens, begin) :]).intersection(following[: bisect_left(following, stop)])
                splice = max((p for p in both if text[p - 1 : p + 1] not in self.pairs), default=0)
                if splice or begin == done:
                    break
                overlap, self.widened = 2 * overlap, self.widened + 1
            if splice:
                n += bisect_left(tokens, splice) - bisect_left(tokens, done)
                done, tokens = splice, following[bisect_left(following, splice) :]
            else:
                tokens = following
            stop = end
        return n + len(tokens)


@cache
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Operator: doc_id, n_bytes, n_tokens and over_limit of each whole text.

    Texts of more than CHUNK characters are encoded in overlapping chunks that are spliced where both
    have a token boundary at a proven place. Shorter ones are counted segment by segment between the same
    proven boundaries, each segment once a worker. A long text that is nowhere provable, as
    one letter over and over, has no place to splice, so its overlap widens to all of it.

    Null and empty texts have no tokens; repeated rows are counted each; an empty table gives no
    rows. Special strings are ordinary text, as the library takes them.
    """
    path = path or model_path()

    def run(rows):
        count = counter(path).count
        n = [count(t) for t in rows["text"]]
        return {"doc_id": rows["doc_id"], "n_bytes": [len(t.encode()) for t in rows["text"]], "n_tokens": n, "over_limit": [k > limit for k in n]}

    return map_rows(doc_texts(docs), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
