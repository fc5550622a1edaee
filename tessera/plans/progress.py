"""What a workspace is busy with, where others can read it, and how it is stopped."""

from __future__ import annotations

import time
import uuid

from tessera.sources.tables import Store


class Cancelled(RuntimeError):
    """A run was stopped on request."""


class Run:
    """A run of some work on a workspace: its state is a small file that is written anew at each stage.

    Spark jobs of the run's thread carry a tag, so that :func:`cancel` can end them.
    """

    def __init__(self, store: Store, job: str, n_items: int):
        self.store, self.job, self.name = store, job, f"{job}-{uuid.uuid4().hex}"
        self.value = {"run": self.name, "job": job, "n_items": n_items, "busy": True, "stage": "start", "started": time.time(), "history": []}

    def _put(self) -> None:
        self.store.put(self.store.at("_state", f"{self.job}.json"), self.value, replace=True)

    def at(self, stage: str) -> None:
        """Note that a stage begins; a run that was cancelled stops here at the latest."""
        if self.cancelled():
            raise Cancelled(self.name)
        self.value["stage"] = stage
        self.value["history"].append([stage, time.time()])
        self._put()

    def cancelled(self) -> bool:
        return self.store.get(self.store.at("_state", f"cancel-{self.name}.json")) is not None

    def __enter__(self) -> Run:
        self.store.spark.sparkContext.addJobTag(self.name)
        self._put()
        return self

    def __exit__(self, kind, error, trace) -> None:
        self.store.spark.sparkContext.removeJobTag(self.name)
        self.value |= {"busy": False, "ended": time.time(), "error": None if error is None else f"{kind.__name__}: {error}"[:2000]}
        self._put()


def state(store: Store, job: str) -> dict | None:
    """The state of the latest run of a job: run, n_items, busy, stage, started, history, and at the end ended and error."""
    return store.get(store.at("_state", f"{job}.json"))


def cancel(store: Store, job: str) -> bool:
    """Ask the run of a job to stop and end its Spark jobs; False if none runs."""
    found = state(store, job)
    if not found or not found["busy"]:
        return False
    store.put(store.at("_state", f"cancel-{found['run']}.json"), {"at": time.time()}, replace=True)
    store.spark.sparkContext.cancelJobsWithTag(found["run"])
    return True
