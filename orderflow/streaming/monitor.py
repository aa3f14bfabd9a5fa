"""Progress and failure log of streaming queries."""

from __future__ import annotations

import logging

from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)


class ProgressLog(StreamingQueryListener):
    """Logs rows per micro-batch, rows dropped as late, and failures."""

    def onQueryStarted(self, event):
        log.info("query %s started", event.id)

    def onQueryProgress(self, event):
        progress = event.progress
        late = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        batch = f"query {progress.id} batch {progress.batchId}"
        log.info("%s: %s input rows", batch, progress.numInputRows)
        if late:
            # Counted per operator and window, not per input row.
            log.warning("%s: %s late updates dropped", batch, late)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            log.error("query %s failed: %s", event.id, event.exception)
        else:
            log.info("query %s ended", event.id)
