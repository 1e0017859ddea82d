"""Token ids of texts by a public tokenizer file, each distinct piece of text encoded once.

The byte-level pattern never joins a character that is no white space with white space
after it, nor a letter with punctuation after it, and what follows such a place is split
without regard to what precedes it. A text may therefore be cut there: its ids are those
of the pieces, one after another. The tokenizers library encodes every piece.
"""

import os

import numpy as np

from spendgrid.llm.arrays import SPACE, SpanHash, ranges

PIECES_AT_ONCE = 64
_MARKS = np.zeros(256, bool)
_MARKS[list(b"!\"#$%&'()*+,-./:;=?@[]_{}~")] = True
_LETTER = np.zeros(256, bool)
_LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True


_encoders = {}


def shared_encoder(path):
    """The encoder of this Python process, which serves many tasks and keeps what it has encoded."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    """Encodes rows of bytes; remembers up to `remember` distinct pieces."""

    def __init__(self, path, remember=400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        lone = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_break = lone[0] if len(lone) == 1 else None
        self.remember = remember
        self.forget()

    def forget(self):
        self.keys = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int32)
        self.lengths = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, data, offsets, end_id):
        """Ids of all rows with end_id after each, and the offsets of the rows in them."""
        cuts = self._cuts(data, offsets)
        starts, ends = cuts[:-1], cuts[1:]
        keys, first, which = np.unique(SpanHash(data)(starts, ends), return_index=True, return_inverse=True)
        place = self._known(keys, data, starts[first], ends[first])[which]
        lengths = self.lengths[place].astype(np.int64)
        ids = self.ids[ranges(self.starts[place], lengths)]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        bounds = sums[np.searchsorted(cuts, offsets)] + np.arange(len(offsets))
        out = np.full(bounds[-1], end_id, np.uint32)
        own = np.ones(len(out), bool)
        own[bounds[1:] - 1] = False
        out[own] = ids
        return out, bounds

    @staticmethod
    def _cuts(data, offsets):
        """Row starts, and places where the pattern ends a token whatever comes next."""
        at = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            before, after = data[:-1], data[1:]
            plain, letter = (before > 0x20) & (before < 0x7F), _LETTER[before]
            lead = data[:-2]
            # Two-byte characters: none from U+00C0 on is white space; most of U+00C0 to U+00FF are letters.
            plain[1:] |= (before[1:] >= 0x80) & (lead >= 0xC3) & (lead <= 0xDF)
            letter[1:] |= (before[1:] >= 0x80) & (lead == 0xC3) & (before[1:] != 0x97) & (before[1:] != 0xB7)
            at[1:-1] = SPACE[after] & plain | _MARKS[after] & letter
        at[offsets] = True
        return np.flatnonzero(at)

    def _known(self, keys, data, starts, ends):
        """Where the pieces with these sorted keys stand in the store; unseen ones are encoded first."""
        if len(self.keys) > self.remember:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        new = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            flat, lengths = self._encode_pieces(data, starts[new], ends[new])
            self.starts = np.insert(self.starts, at[new], len(self.ids) + np.cumsum(lengths) - lengths)
            self.lengths = np.insert(self.lengths, at[new], lengths)
            self.keys = np.insert(self.keys, at[new], keys[new])
            self.ids = np.concatenate([self.ids, flat])
            at = np.searchsorted(self.keys, keys)
        return at

    def _encode_pieces(self, data, starts, ends):
        """Ids of the pieces, one after another, and how many each has.

        Most pieces are encoded many at a time with a line break between them, which is
        a token of its own there; others, such as those with line breaks, one by one.
        """
        raw = data.tobytes()
        breaks = np.concatenate([[0], np.cumsum(SPACE[data])])
        inside = breaks[ends] - breaks[starts]
        last, lead = data[ends - 1], data[np.maximum(ends - 2, 0)]
        sure = (last > 0x20) & (last < 0x7F) | (last >= 0x80) & (lead >= 0xC3) & (lead <= 0xDF) & (ends - starts > 1)
        joined = sure & (inside == ((data[starts] == 0x20) & (ends - starts > 1))) if self.line_break is not None else np.zeros(len(starts), bool)
        order = np.concatenate([np.flatnonzero(joined), np.flatnonzero(~joined)])
        n = int(joined.sum())
        pieces = [raw[s:e] for s, e in zip(starts[order].tolist(), ends[order].tolist())]
        texts = [b"\n".join(pieces[i : min(i + PIECES_AT_ONCE, n)] + [b""]) for i in range(0, n, PIECES_AT_ONCE)] + pieces[n:]
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        k = -(-n // PIECES_AT_ONCE)
        together = np.concatenate([np.zeros(0, np.uint32)] + [np.array(e.ids, np.uint32) for e in found[:k]])
        alone = [np.array(e.ids, np.uint32) for e in found[k:]]
        stops = np.flatnonzero(together == self.line_break) if k else np.zeros(0, np.int64)
        assert len(stops) == n, "a line break did not stay a token of its own"
        lengths = np.empty(len(starts), np.int64)
        lengths[: n] = np.diff(stops, prepend=-1) - 1
        lengths[n:] = [len(x) for x in alone]
        flat = np.concatenate([together[together != self.line_break] if k else together, *alone])
        # Back into the order of the keys.
        begin = np.cumsum(lengths) - lengths
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return flat[ranges(begin[back], lengths[back])], lengths[back]
