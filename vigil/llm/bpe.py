"""Byte-level BPE ids as the ``tokenizers`` library gives them, and back.

``Encoder`` gives exactly the ids of ``Tokenizer.encode(text,
add_special_tokens=False)``. It cuts a text where the pre-tokenizer is bound
to cut (a single space or newline after a non-space starts a new pre-token,
whatever surrounds it) and remembers the ids of the pieces, so each spelling
is merged once per Python worker instead of once per occurrence. Texts in
which such a cut isn't certain go to the library whole. New pieces of plain
Latin text are merged by ``tiktoken`` from the same vocabulary (its calls cost
a third as much), all others by ``tokenizers``; the tests hold both together.
"""

from __future__ import annotations

import re
from array import array

#: white space followed by a space or newline: a run that must not be cut
_RUN = re.compile(r"\s[ \n]")
_MARK = "\0"
#: characters on whose classes the two libraries' regex engines agree
_PLAIN = re.compile(r"[\n\x20-\x7e\u00c0-\u017f]*")


def default_tokenizer_path() -> str:
    """Place of the public byte-level BPE vocabulary on this machine."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes; pieces are memoised up to
    ``max_pieces`` (the memo is then started anew, so memory is bounded)."""

    def __init__(self, path: str, max_pieces: int = 600_000, longest: int = 100):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        self.specials = tuple(t.content for t in added.values())
        self.max_pieces, self.longest = max_pieces, longest
        self.memo: dict[str, bytes] = {"": b""}
        self._table = self._byte_table()
        self._plain = self._plain_encoder()

    def _plain_encoder(self):
        """The same merges by tiktoken, if the ids are merge ranks (they are
        in this family of vocabularies) and the pre-tokenizer is its own."""
        import public_tokenizers
        import tiktoken
        special = self.tokenizer.get_added_tokens_decoder()
        ranks = {b: i for i, b in enumerate(self._table) if i not in special}
        if len(ranks) + len(special) != len(self._table) or max(ranks[bytes([b])] for b in range(256)) > 255:
            return None
        return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})._core_bpe.encode_ordinary

    def _merge(self, pieces: list[str]) -> dict[str, bytes]:
        plain, out = self._plain, {}
        rest = pieces if plain is None else []
        if plain is not None:
            for p in pieces:
                if _PLAIN.fullmatch(p):
                    out[p] = array("I", plain(p)).tobytes()
                else:
                    rest.append(p)
        if rest:
            out.update(zip(rest, self._library(rest), strict=True))
        return out

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def has_special(self, text: str) -> bool:
        return any(s in text for s in self.specials)

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = []
        cut: list[tuple[int, list[str]]] = []
        direct: list[int] = []
        for i, text in enumerate(texts):
            out.append(b"")
            if not text:
                continue
            if _MARK in text or self.has_special(text) or _RUN.search(text):
                direct.append(i)
            else:
                cut.append((i, text.replace(" ", "\0 ").replace("\n", "\0\n").split(_MARK)))
        for i in direct:
            out[i] = self._library([texts[i]])[0]
        for i, pieces in cut:
            memo = self.memo
            try:
                out[i] = b"".join(map(memo.__getitem__, pieces))
            except KeyError:
                ids = self._merge(list(set(pieces).difference(memo)))
                out[i] = b"".join([ids[p] if p in ids else memo[p] for p in pieces])
                if len(memo) + len(ids) > self.max_pieces:  # start anew with what this text has
                    self.memo = {p: memo[p] for p in set(pieces).intersection(memo)} | {"": b""}
                self.memo.update((p, b) for p, b in ids.items() if len(p) <= self.longest)
        return out

    def decode(self, ids: bytes) -> str:
        """``Tokenizer.decode(ids, skip_special_tokens=False)``."""
        table = self._table
        return b"".join([table[i] for i in array("I", ids)]).decode("utf-8", "replace")

    def _byte_table(self) -> list[bytes]:
        """Bytes of every id. Byte-level vocabularies spell the printable
        Latin-1 bytes as themselves and the others, in order, from U+0100."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        return [special[i].encode() if i in special
                else bytes(byte[c] for c in self.tokenizer.id_to_token(i)) for i in range(size)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder (and memo) per Python worker and vocabulary."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
