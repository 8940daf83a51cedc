"""Steps of a micro-batch that are done once each, however often the batch is."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame

from ..session import delete_path, exists, put_mark

Sink = Callable[[DataFrame, int], None]


class StepsFailed(RuntimeError):
    """Some steps of a micro-batch raised; the others are done and marked."""

    def __init__(self, batch_id: int, errors: Mapping[str, Exception]):
        super().__init__(f"batch {batch_id}: " + "; ".join(f"{name}: {error}" for name, error in errors.items()))
        self.errors = dict(errors)


def run_steps(batch: DataFrame, batch_id: int, steps: Mapping[str, Sink], marks: str) -> None:
    """Give ``batch`` to every step that ``marks`` doesn't have as done with it, and mark those that end.

    A step that raises does not keep the others from running; the batch fails after them, and when it is done again, only
    the steps that failed are. The batch is computed once for all that are left, and not at all if none is.
    """
    spark = batch.sparkSession
    places = {name: f"{marks}/step={quote(name, safe='')}" for name in steps}
    todo = [name for name in steps if not exists(spark, f"{places[name]}/batch={batch_id}")]
    if not todo:
        return
    errors: dict[str, Exception] = {}
    shared = batch.persist() if len(todo) > 1 else batch
    try:
        for name in todo:
            try:
                steps[name](shared, batch_id)
            except Exception as error:
                errors[name] = error
            else:
                put_mark(spark, f"{places[name]}/batch={batch_id}")
                delete_path(spark, f"{places[name]}/batch={batch_id - 2}")
    finally:
        if shared is not batch:
            shared.unpersist()
    if errors:
        raise StepsFailed(batch_id, errors) from next(iter(errors.values()))
