"""A SentencePiece BPE vocabulary and the exact facts the tokenizer operators rest on.

Two facts about byte-pair encoding make work per distinct word exact:

* No merge crosses a place that no piece spans, so a text may be cut there and its parts encoded
  on their own. ``segment`` cuts only at such places; which characters may be cut apart is read
  from the vocabulary itself.
* A sequence of pieces is the encoding of its text if and only if each neighbouring pair is the
  encoding of that pair's text. So each prefix has exactly one last piece that fits the prefix
  before it, and prefix encodings can be built left to right (see ``prefix_pieces``).
"""

from __future__ import annotations

import re
from functools import lru_cache

SPACE = "▁"
DEFAULT_MODEL = "piece_bpe_32k.model"


def model_path(path: str) -> str:
    """``path`` itself, or where the installed tokenizer files have a bare file name."""
    if "/" in path:
        return path
    import public_tokenizers

    return public_tokenizers.path(path)


class PieceModel:
    """Pieces of a ``.model`` file with identity normalisation, dummy prefix and byte fallback."""

    def __init__(self, path: str, memo: int = 300_000):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: list[bytes] = []
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte = int(piece[3:5], 16)
                self.byte_ids[byte] = i
                self.pieces.append(bytes([byte]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.pieces.append(b"")
            else:
                self.ids[piece] = i
                self.score[piece] = sp.get_score(i)
                self.pieces.append(piece.replace(SPACE, " ").encode())
        self.text_of = {i: p for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        # Lengths of the pieces that end in given two characters (or are just one), longest first.
        tails: dict[str, set[int]] = {}
        for piece in self.ids:
            tails.setdefault(piece[-2:], set()).add(len(piece))
            tails.setdefault(piece[-2:], set()).add(1)
        self.tails = {t: sorted(n, reverse=True) for t, n in tails.items()}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece has a space inside: words can't be encoded apart")
        # Characters that some piece has right after a letter stay with the letters before them.
        joined = {b for p in self.ids for a, b in zip(p, p[1:]) if a.isalpha() and not b.isalpha()}
        inside = "".join(re.escape(c) for c in sorted(joined - {SPACE}))
        letters = rf"(?:[^\W\d_]|[{inside}])" if inside else r"[^\W\d_]"
        others = rf"(?:(?![^\W\d_]|[{inside}])[^{SPACE}])" if inside else rf"(?:(?![^\W\d_])[^{SPACE}])"
        self.segment = re.compile(rf"{SPACE}*{others}*{letters}+|{SPACE}*{others}+|{SPACE}+", re.S).findall
        self.memo = memo
        self.pairs: dict[int, bool] = {}
        self.sorted_pairs = None  # the same facts as arrays, for those who ask for many at once

    def words(self, text: str) -> list[str]:
        """The text's parts; joined they are the text with its dummy prefix and marked spaces."""
        return self.segment(SPACE + text.replace(" ", SPACE)) if text else []

    def merge(self, text: str) -> list[str]:
        """The plain rule: merge the best-scored neighbouring pair, the leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stays(self, a: int, b: int) -> bool:
        """As ``fits``, worked out anew."""
        left, right = self.text_of[a], self.text_of[b]
        return self.merge(left + right) == [left, right]

    def fits(self, a: int, b: int) -> bool:
        """Whether pieces ``a`` and ``b`` stay as they are when their texts stand side by side."""
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is None:
            known = self.stays(a, b)
            if len(self.pairs) >= self.memo:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def weight(self, char: str) -> int:
        """Tokens of a character outside the vocabulary: one per UTF-8 byte."""
        return len(char.encode("utf-8", "surrogatepass"))

    def prefix_pieces(self, word: str, last: list[int], count: list[int]) -> None:
        """Extend prefix states to the whole of ``word``.

        ``last[k]`` and ``count[k]`` are the last piece (-1: a character by bytes) and the token
        count of ``word[:k + 1]``; the states already given are those of a prefix of ``word``.
        """
        ids, tails, fits, pairs = self.ids.get, self.tails.get, self.fits, self.pairs
        for end in range(len(last) + 1, len(word) + 1):
            found, total = -1, 0
            for n in tails(word[end - 2 : end] if end > 1 else word[:1], ()) or tails(word[end - 1], ()):
                start = end - n
                if start < 0:
                    continue
                piece = ids(word[start:end])
                if piece is None:
                    continue
                if start == 0:
                    found, total = piece, 1
                    break
                before = last[start - 1]
                if before >= 0:
                    ok = pairs.get(before << 20 | piece)
                    if not (fits(before, piece) if ok is None else ok):
                        continue
                found, total = piece, count[start - 1] + 1
                break
            if found < 0:
                total = (count[end - 2] if end > 1 else 0) + self.weight(word[end - 1])
            last.append(found)
            count.append(total)

    def prefix_counts(self, words: list[str]) -> dict[str, bytes | list[int]]:
        """Token counts at each prefix of each word.

        Words are taken in order, so that a word goes on from the states of the prefix it shares
        with the one before it.
        """
        out: dict[str, bytes | list[int]] = {}
        before, last, count = "", [], []
        for word in sorted(words):
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared:], count[shared:]
            self.prefix_pieces(word, last, count)
            before = word
            out[word] = bytes(count) if count[-1] < 256 else count.copy()
        return out

    def decode(self, ids) -> str:
        """Text of a token sequence; the dummy prefix's space is dropped."""
        pieces = self.pieces
        raw = b"".join([pieces[i] for i in ids])
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str = DEFAULT_MODEL) -> PieceModel:
    """One model per Python worker and path."""
    return PieceModel(model_path(path))
