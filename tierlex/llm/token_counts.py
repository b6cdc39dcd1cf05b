"""Token counts by byte-pair merging, without making any identifiers.

The vocabulary file is read for its pieces and their merge order only; merging is done here: a linked
list of symbols and a heap of adjacent pairs, from which the pair of the lowest rank, the leftmost
first, is popped until none is left.  A text's count is its initial symbols minus its merges.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import bound_batches, ship
from .textarrays import small_batches

SPACE = "▁"
#: No piece of the vocabulary has another character before a blank, so merges stay within such a chunk.
CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Entries of a worker's memory of chunks; when it is full, the memory starts anew.
MEMORY = 400_000
LIMIT = 4096


def load_ranks(path: str) -> dict[str, int]:
    """Piece to rank (0 merges first; equal scores share a rank) of a sentencepiece BPE model with byte fallback."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    usable = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in usable}, reverse=True))}
    ranks = {sp.id_to_piece(i): order[sp.get_score(i)] for i in usable}
    if any(SPACE in p.lstrip(SPACE) for p in ranks):
        raise ValueError("a piece holds a blank after another character: texts can't be cut before blanks")
    return ranks


def count_chunk(chunk: str, ranks: dict[str, int]) -> int:
    """Tokens of one chunk: initial symbols minus merges; a character without a piece is as many symbols as it has bytes."""
    n = len(chunk)
    total = 0
    for c in chunk:
        total += 1 if c in ranks else len(c.encode("utf-8", "surrogatepass"))
    if n == 1:
        return total
    heap = []
    for i in range(n - 1):
        r = ranks.get(chunk[i : i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapify(heap)
    # symbol i covers chunk[i:end[i]]; before[i] is where the symbol to its left begins
    end, before, merges = list(range(1, n + 1)), list(range(-1, n)), 0
    alive = [True] * n
    while heap:
        _, left, stop = heappop(heap)
        if not alive[left] or (right := end[left]) >= stop or end[right] != stop:
            continue  # a part has been merged otherwise since
        alive[right] = False
        end[left] = stop
        merges += 1
        if stop < n:
            before[stop] = left
            if (r := ranks.get(chunk[left : end[stop]])) is not None:
                heappush(heap, (r, left, end[stop]))
        if (p := before[left]) >= 0 and (r := ranks.get(chunk[p:stop])) is not None:
            heappush(heap, (r, p, stop))
    return total - merges


def counter(ranks: dict[str, int], memory: int = MEMORY) -> Callable[[str], int]:
    """A function from text to its number of tokens that remembers chunks."""
    known: dict[str, int] = {}

    def count(text: str) -> int:
        if not text:
            return 0
        total = 0
        for chunk in CHUNK.findall(SPACE + text.replace(" ", SPACE)):
            n = known.get(chunk)
            if n is None:
                n = count_chunk(chunk, ranks)
                if len(chunk) <= 64:
                    if len(known) >= memory:
                        known.clear()
                    known[chunk] = n
            total += n
        return total

    return count


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    A null or empty text has 0 bytes and 0 tokens.  Repeated rows are each counted; an empty table
    gives no rows.  The path is opened on the driver alone; ranks travel with the tasks.
    """
    bound_batches(docs.sparkSession)
    ranks = load_ranks(model_path)
    shared = ship(docs.sparkSession, ranks)  # as large as the vocabulary, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(shared())
        for batch in small_batches(batches):
            texts = batch.column(1).to_pylist()
            tokens = [count(t) if t else 0 for t in texts]
            sizes = [len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    slim = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text")
    return slim.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
