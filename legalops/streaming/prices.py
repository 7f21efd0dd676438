"""The price check on contract lines as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from legalops.operators.pricing import look_up_prices, sort_out
from legalops.sources.tables import Tables
from legalops.streaming.sink import start, write_sinks


def check_arriving_lines(
    lines: DataFrame, t: Tables, out: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Write each batch's lines to `out`/accepted, /rejected and /changes.

    `sink.read_sinks` reads them: a batch shows in all three or in none.
    The agreements, clients and prices are read anew for every batch, so lines may
    refer to rows added since the stream began.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        # Three sinks read the joined lines: keep them until all are written.
        looked_up = look_up_prices(batch, t).persist()
        checked = sort_out(looked_up, batch.columns)
        write_sinks(checked._asdict(), out, batch_id)
        looked_up.unpersist()

    return start(lines, check, checkpoint, once)
