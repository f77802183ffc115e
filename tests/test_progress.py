"""The log of a long run takes bounded memory and forgets no sum."""

import json
from types import SimpleNamespace

from streamwin.streaming import ProgressLog


def event(run, number):
    batch = {
        "runId": run,
        "batchId": number,
        "timestamp": f"2024-03-01T{number // 3600:02d}:{number // 60 % 60:02d}:{number % 60:02d}.000Z",
        "stateOperators": [{"memoryUsedBytes": 1 << 20, "numRowsDroppedByWatermark": number % 2}],
        "durationMs": {"triggerExecution": 500},
        "processedRowsPerSecond": 2.0,
        "numInputRows": 3,
    }
    return SimpleNamespace(progress=SimpleNamespace(json=json.dumps(batch)))


def test_a_long_run_keeps_its_newest_batches_and_all_sums():
    log = ProgressLog(tail=100)
    for number in range(10_000):
        log.onQueryProgress(event("a", number))
        if number < 5:
            log.onQueryProgress(event("b", number))
    for run, batches, late in (("a", 10_000, 5000), ("b", 5, 2)):
        last = json.loads(event(run, batches - 1).progress.json)
        query = SimpleNamespace(runId=run, lastProgress=last)
        assert log.knows(query)
        kept = log.batches(query)
        assert [batch["batch"] for batch in kept] == list(range(max(0, batches - 100), batches))
        assert kept[-1]["elapsed"] == batches - 1
        assert log.totals(query) == {"batches": batches, "input_rows": 3 * batches, "late_rows": late}
    assert not log.knows(SimpleNamespace(runId="c"))
