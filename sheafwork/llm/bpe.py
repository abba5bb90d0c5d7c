"""Byte-level BPE: DuckDB recursive queries encode, ordered aggregation decodes.

Each Spark task cuts its texts into pieces and gives its distinct pieces to a DuckDB of its own. There,
rows (word, position, token) join the merge table; each word's leftmost pair of least rank is
contracted, round after round, until no word has a pair left. In pieces of more than ``SHORT`` bytes all pairs
of least rank for some way around are contracted in one round, and rows are replaced by key, so that a query
holds one row per byte however many rounds it takes. A piece that is a token as a whole is that
token. Ids are then put together per text, and decoded by an aggregation ordered by position.

Defined results: a null text is an empty one, an empty text has no ids and decodes to no bytes; every
text, however long, is encoded whole, a piece of any length too; repeated rows and null ids of
documents are rows like any other; extra columns are ignored; an empty table gives an empty table. Text
that looks like a special token is plain text.
"""

from __future__ import annotations

import base64
import os
import tempfile
import unicodedata
import uuid
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frugal import over_batches
from .words import hash_ranges, slices, text_bytes

# Pieces a task keeps the tokens of; beyond it the memory starts anew. Results don't depend on it.
REMEMBERED = 400_000
# Bytes of pieces in one recursive query.
QUERY_BYTES = 1 << 19
MEMORY = "400MB"
# Bytes of texts worked on at once; their pieces and ids take many times that on their way.
SLICE = 1 << 21
BLOCKS = 4
# Bytes of a short piece at most, and rows that the rounds of one query of short pieces have at most.
SHORT, QUERY_ROWS = 128, 1 << 22
_DECODED = ", decoded binary"
SCHEMA = "doc_id bigint, n_tokens bigint, ids string" + _DECODED

_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3
# Code points with the White_Space property, and the endings that are cut off.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

# For short pieces: every round has its own rows, the square of a piece's length at most.
ENCODE_SHORT = """
WITH RECURSIVE step AS (
  SELECT 0 AS round, p.word, p.place, p.token, p.next_place, p.next_token, m.rank
  FROM pairs p LEFT JOIN merges m ON m.lhs = p.token AND m.rhs = p.next_token
  UNION ALL
  SELECT x.round + 1, x.word, x.place, x.token, x.next_place, x.next_token,
         CASE WHEN x.changed THEN m.rank ELSE x.rank END
  FROM (
    SELECT r.round, r.word, r.place, r.rank,
           CASE WHEN r.place = c.at THEN c.rank ELSE r.token END AS token,
           CASE WHEN r.place = c.at THEN c.gone_next ELSE r.next_place END AS next_place,
           CASE WHEN r.place = c.at THEN c.gone_token WHEN r.next_place = c.at THEN c.rank ELSE r.next_token END AS next_token,
           r.place = c.at OR r.next_place = c.at AS changed
    FROM step r
    JOIN (
      SELECT least.word, least.rank, least.at, least.gone, g.next_place AS gone_next, g.next_token AS gone_token
      FROM (
        SELECT word, min(rank) AS rank, arg_min(place, rank::BIGINT << 32 | place) AS at,
               arg_min(next_place, rank::BIGINT << 32 | place) AS gone
        FROM step WHERE rank IS NOT NULL GROUP BY word
      ) least
      JOIN step g ON g.word = least.word AND g.place = least.gone
    ) c ON r.word = c.word
    WHERE r.place <> c.gone
  ) x
  LEFT JOIN merges m ON m.lhs = CASE WHEN x.changed THEN x.token END AND m.rhs = x.next_token
)
SELECT s.word, s.place, s.token FROM step s
JOIN (SELECT word, max(round) AS round FROM step GROUP BY word) l ON s.word = l.word AND s.round = l.round
"""
# For long pieces: a row per place of a word, replaced in every round; places that are merged away have no token. A pair is
# contracted when no pair in its block or the two beside it has a less rank. Blocks are ``BLOCKS`` times the
# longest token, and whatever is contracted earlier elsewhere would have to reach over one to touch it, so all
# of a round's contractions are those of the order by rank and place. Equal neighbours go from the left, every
# other one. ``alone`` marks ranks that lead to a pair of less rank: of those, only the leftmost is contracted.
ENCODE_LONG = """
WITH RECURSIVE step(word, place, token, next_place, next_token, rank) USING KEY (word, place) AS (
  SELECT p.word, p.place, p.token, p.next_place, p.next_token, m.rank
  FROM pairs p LEFT JOIN merges m ON m.lhs = p.token AND m.rhs = p.next_token
  UNION ALL
  (WITH least AS (
    SELECT word, place // {block} AS block, min(rank::BIGINT << 32 | place) AS least
    FROM recurring.step WHERE rank IS NOT NULL GROUP BY ALL
  ), bounds AS (
    SELECT word, block + d AS block, min(least) AS least FROM least, (VALUES (-1), (0), (1)) near(d) GROUP BY ALL
  ), candidates AS (
    SELECT s.word, s.place, s.next_place, s.rank
    FROM recurring.step s JOIN bounds b ON b.word = s.word AND b.block = s.place // {block}
    WHERE s.rank = b.least >> 32 AND (s.place = b.least & 4294967295 OR s.rank NOT IN (SELECT rank FROM alone))
  ), runs AS (
    SELECT *, CASE WHEN lag(next_place) OVER w = place AND lag(rank) OVER w = rank THEN 0 ELSE 1 END AS opens
    FROM candidates WINDOW w AS (PARTITION BY word ORDER BY place)
  ), numbered AS (
    SELECT *, sum(opens) OVER (PARTITION BY word ORDER BY place) AS run FROM runs
  ), placed AS (
    SELECT *, row_number() OVER (PARTITION BY word, run ORDER BY place) AS n FROM numbered
  ), waiting AS (
    SELECT f.word, f.run FROM placed f JOIN recurring.step s ON s.word = f.word AND s.next_place = f.place AND s.rank = f.rank
    WHERE f.n = 1 AND s.token IS NOT NULL
  ), chosen AS (
    SELECT c.word, c.place, c.next_place, c.rank FROM placed c
    ANTI JOIN waiting q ON q.word = c.word AND q.run = c.run WHERE c.n % 2 = 1
  ), changed AS (
    SELECT c.word, c.place, c.rank AS token, g.next_place, coalesce(n.rank, g.next_token) AS next_token
    FROM chosen c JOIN recurring.step g ON g.word = c.word AND g.place = c.next_place
    LEFT JOIN chosen n ON n.word = g.word AND n.place = g.next_place
    UNION ALL
    SELECT p.word, p.place, p.token, p.next_place, c.rank
    FROM recurring.step p JOIN chosen c ON c.word = p.word AND c.place = p.next_place
    ANTI JOIN chosen k ON k.word = p.word AND k.next_place = p.place
    UNION ALL
    SELECT word, next_place, NULL, NULL, NULL FROM chosen
  )
  SELECT x.word, x.place, x.token, x.next_place, x.next_token, m.rank
  FROM changed x LEFT JOIN merges m ON m.lhs = x.token AND m.rhs = x.next_token)
)
SELECT word, place, token FROM step WHERE token IS NOT NULL
"""
DECODE = """
SELECT e.word, string_agg(e.token::VARCHAR, ',' ORDER BY e.place) AS ids, count(*) AS n,
       string_agg(v.hexed, '' ORDER BY e.place) AS hexed
FROM encoded e JOIN vocabulary v ON v.rank = e.token GROUP BY e.word
"""


def _classes() -> np.ndarray:
    kinds = np.full(0x110000, _OTHER, np.uint8)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            kinds[point] = _LETTER
        elif kind == "N":
            kinds[point] = _NUMBER
    kinds[_WHITE] = _SPACE
    return kinds


def piece_starts(points: np.ndarray, docs: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where pieces start, given code points of several texts and where each text starts.

    The public pattern, written for all characters at once: runs of letters, of numbers and of other
    characters, each with one blank before it; runs of white space without the character that comes
    before a run; and the endings of ``_ENDINGS`` after an apostrophe that begins a piece.
    """
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    kind = kinds[points]
    first = np.zeros(n + 1, bool)
    first[docs] = True
    first[n] = True
    first[1:n] |= kind[1:] != kind[:-1]
    new_text = np.zeros(n + 1, bool)
    new_text[docs] = True
    new_text[n] = True
    start = first.copy()
    runs = np.flatnonzero(first[:n])
    # Runs that follow white space in the same text.
    after = runs[(runs > 0) & ~new_text[runs]]
    after = after[kind[after - 1] == _SPACE]
    start[after - 1] = True
    joined = after[points[after - 1] == 0x20]
    start[joined] = False
    # Endings: a lone apostrophe that begins a piece, and letters of the same text behind it.
    lone = np.flatnonzero((points == 0x27) & start[:n] & first[:n] & first[1:])
    lone = lone[(lone + 1 < n)]
    lone = lone[~new_text[lone + 1]]
    for ending in _ENDINGS:
        fits = lone[lone + len(ending) < n]
        for k, letter in enumerate(ending, 1):
            fits = fits[(points[fits + k] == ord(letter)) & ((k == 1) | ~first[fits + k])]
        start[fits + 1] = False
        start[fits + 1 + len(ending)] = True
    return np.flatnonzero(start[:n])


class Coder:
    """Encoder and decoder of one task, over the ranks of one file."""

    def __init__(self, ranks_path: str):
        with open(ranks_path, "rb") as file:
            pairs = (line.split() for line in file.read().splitlines() if line)
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.names = {rank: token for token, rank in self.ranks.items()}
        self.kinds = _classes()
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        lhs, rhs, rank = [], [], []
        for token, number in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    lhs.append(left)
                    rhs.append(right)
                    rank.append(number)
        # Made only when something is spilled.
        spill = os.path.join(tempfile.gettempdir(), f"sheafwork-bpe-{uuid.uuid4().hex}")
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": spill})
        self.encode_long = ENCODE_LONG.format(block=BLOCKS * max(map(len, self.ranks)))
        merges = pa.table({"lhs": pa.array(lhs, pa.int32()), "rhs": pa.array(rhs, pa.int32()), "rank": pa.array(rank, pa.int32())})
        names = pa.table({"rank": pa.array(list(self.ranks.values()), pa.int32()), "hexed": [t.hex() for t in self.ranks]})
        for name, table in (("merges", merges), ("vocabulary", names)):
            self.db.register("incoming", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
            self.db.unregister("incoming")
        self.db.execute(
            "CREATE TABLE alone AS SELECT lhs AS rank FROM merges WHERE rank <= lhs UNION SELECT rhs FROM merges WHERE rank <= rhs"
        )
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.slot = np.empty(0, np.int64)
        self.ids: list[str] = []
        self.counts: list[int] = []
        self.decoded: list[bytes] = []

    def learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """Work out tokens of pieces not seen so far."""
        ids: list = [None] * len(pieces)
        decoded: list = [None] * len(pieces)
        counts = [1] * len(pieces)
        # Open pieces, their bytes, and the rows of their rounds; of short and of long ones.
        opened = {True: ([], 0, 0), False: ([], 0, 0)}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                ids[i], decoded[i] = str(rank), self.names[rank]
                continue
            n = len(piece)
            short = n <= SHORT
            chosen, size, rows = opened[short]
            chosen.append(i)
            opened[short] = chosen, size + n, rows + n * (n + 1) // 2
            if size + n >= QUERY_BYTES or (short and opened[short][2] >= QUERY_ROWS):
                self._query(short, chosen, pieces, ids, counts, decoded)
                opened[short] = [], 0, 0
        for short, (chosen, *_) in opened.items():
            if chosen:
                self._query(short, chosen, pieces, ids, counts, decoded)
        place = np.arange(len(self.ids), len(self.ids) + len(pieces))
        self.ids += ids
        self.counts += counts
        self.decoded += decoded
        every = np.concatenate([self.known, hashes])
        order = np.argsort(every, kind="stable")
        self.known, self.slot = every[order], np.concatenate([self.slot, place])[order]

    def _query(self, short: bool, chosen: list[int], pieces: list[bytes], ids: list, counts: list, decoded: list) -> None:
        lengths = np.array([len(pieces[i]) for i in chosen])
        data = np.frombuffer(b"".join(pieces[i] for i in chosen), np.uint8)
        word = np.repeat(np.arange(len(chosen), dtype=np.int32), lengths)
        place = (np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        token, last = self.single[data], np.cumsum(lengths) - 1
        none = np.zeros(len(data), bool)
        none[last] = True
        following = {"next_place": place + 1, "next_token": np.append(token[1:], 0)}
        nexts = {name: pa.array(values.astype(np.int32), mask=none) for name, values in following.items()}
        self.db.register("incoming", pa.table({"word": word, "place": place, "token": token, **nexts}))
        self.db.execute("CREATE OR REPLACE TEMP TABLE pairs AS SELECT * FROM incoming")
        self.db.unregister("incoming")
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE encoded AS {ENCODE_SHORT if short else self.encode_long}")
        for w, text, n, hexed in self.db.execute(DECODE).fetchall():
            ids[chosen[w]], counts[chosen[w]], decoded[chosen[w]] = text, n, bytes.fromhex(hexed)

    def rows(self, doc_ids: pa.Array, texts: pa.Array, decode: bool = True) -> pa.RecordBatch:
        data, offsets = text_bytes(texts)
        points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        # Code points start at bytes that don't continue another.
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        begins = np.searchsorted(heads, offsets)
        starts = heads[piece_starts(points, begins[:-1][begins[:-1] < len(points)], self.kinds)] if len(points) else heads
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        hashes = hash_ranges(data, starts, ends)
        distinct, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.ids) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self.known, distinct)
        fresh = np.ones(len(distinct), bool)
        inside = at < len(self.known)
        fresh[inside] = self.known[at[inside]] != distinct[inside]
        if fresh.any():
            whole = data.tobytes()
            self.learn(distinct[fresh], [whole[starts[i] : ends[i]] for i in where[fresh]])
        slots = self.slot[np.searchsorted(self.known, distinct)][back]
        firsts = np.searchsorted(starts, offsets).tolist()
        counts = np.concatenate([[0], np.cumsum(np.array(self.counts, np.int64)[slots])]) if len(slots) else np.zeros(1, np.int64)
        slots = slots.tolist()
        n, ids, decoded = [], [], []
        for a, b in zip(firsts, firsts[1:]):
            own = slots[a:b]
            n.append(int(counts[b] - counts[a]))
            ids.append(",".join(map(self.ids.__getitem__, own)))
            if decode:
                decoded.append(b"".join(map(self.decoded.__getitem__, own)))
        columns = {"doc_id": doc_ids.cast(pa.int64()), "n_tokens": pa.array(n, pa.int64()), "ids": pa.array(ids, pa.string())}
        if decode:
            columns["decoded"] = pa.array(decoded, pa.binary())
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def encoded(docs: DataFrame, ranks_path: str, decode: bool = True) -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, ``ids`` (decimal, joined by commas), ``decoded`` (bytes, if asked for).

    Texts stay where they are: no exchange. ``ranks_path`` names a rank file every executor has.
    """

    @over_batches
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(ranks_path)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield coder.rows(part.column("doc_id"), part.column("text"), decode)

    schema = SCHEMA if decode else SCHEMA.removesuffix(_DECODED)
    return docs.select("doc_id", "text").mapInArrow(encode, schema)
