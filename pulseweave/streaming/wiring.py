"""The chain of streaming jobs, from topics to topics.

``run_job`` joins a source, a job and a sink.  Source and sink are parameters, so the
same chain runs over a broker (``pulseweave.sources.kafka`` with the decoders and encoders
of ``avro``) and over folders of files.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pulseweave.streaming import jobs

#: Gives the rows of a topic as a stream, in engine form.
Reader = Callable[[str], DataFrame]
#: Starts writing a stream to a topic in an output mode.
Writer = Callable[[DataFrame, str, str], StreamingQuery]


@dataclass(frozen=True)
class Job:
    """``run`` takes one stream per input topic; its result goes to ``output``."""
    inputs: tuple[str, ...]
    output: str
    run: Callable[..., DataFrame]
    mode: str = "append"


JOBS = {
    "flatten": Job(("hub_batches",), "records", jobs.flatten_job),
    "alerts": Job(("records",), "alerts", jobs.alert_job),
    "minutes": Job(("records",), "aggregated_records", jobs.minute_job),
    "averages": Job(("records",), "global_averages", jobs.global_average_job),
    "credit_sessions": Job(("records", "alerts"), "aggregated_records",
                           jobs.credit_session_job, "update"),
    "short_windows": Job(("records",), "session_windows",
                         partial(jobs.class_window_job, route="short")),
    "long_windows": Job(("records",), "session_windows",
                        partial(jobs.class_window_job, route="long")),
    "drifts": Job(("records",), "drift_alerts", jobs.drift_job, "update"),
}


def run_job(name: str, read: Reader, write: Writer, **options) -> StreamingQuery:
    """Start one job; ``options`` are those of its function in ``jobs``."""
    job = JOBS[name]
    return write(job.run(*[read(topic) for topic in job.inputs], **options), job.output, job.mode)
