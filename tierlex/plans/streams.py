"""Queries whose rows come through a stream's state."""

from __future__ import annotations

from ..sources import scratch
from ..streaming import conversations
from .catalog import query
from .lexicon import _TW, text_parts

#: A month: the query's stream ends before any conversation is idle.
IDLE = 30 * 86_400_000

_TALK = r"ct AS (SELECT DISTINCT conv_id, turn, unnest(regexp_extract_all(lower(text), '(\p{L}+)', 1)) AS token FROM conversations), tn AS (SELECT conv_id, count(*) AS turns FROM conversations GROUP BY 1)"


@query(f"{_TW}, {_TALK}, cs AS (SELECT conv_id, grp, sum(weight)::BIGINT AS score FROM ct JOIN gw USING (token) WHERE grp IS NOT NULL GROUP BY ALL), rk AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, grp) AS nth FROM cs) SELECT conv_id, turns, nth, grp, score FROM tn LEFT JOIN (SELECT * FROM rk WHERE nth <= 3) USING (conv_id)")
def conversation_groups(t):
    """The three best groups of every conversation, its turns read as a stream and summed in state by conversation."""
    out, checkpoint = (scratch.new_path(t.spark, name) for name in ("stream", "checkpoint"))
    turns = conversations.read_turns(t.spark, f"{t.folder}/conversations.parquet")
    stream = conversations.run(turns, text_parts(t)[1], out, checkpoint, idle_ms=IDLE)
    stream.awaitTermination()
    return conversations.latest(t.spark, out).drop("closed")
