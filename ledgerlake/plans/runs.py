"""What makes a pipeline run safe to start and to repeat: the lease, the manifest and the order of models.

* **Lease.** One run at a time writes a lake.  The file ``_runs/_lease`` holds
  the attempt that has it and when it last said so; a thread renews it.  Another
  attempt is refused unless the lease has not been renewed for ``ttl`` seconds
  (the driver was killed).  An attempt that lost its lease finds out before it
  publishes its next model and stops.
* **Manifest.** ``_runs/<run>/_<step>`` is written when a step of the run has
  stored its result.  A retry of the run (same load time and run id) skips these
  steps and reads what they stored.
* **Order.** Steps start as soon as the steps they depend on are done, not
  layer by layer.  A failing step is tried again with growing pauses; if it
  stays failed, only what depends on it is held back.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from ledgerlake.sources import files


class RunActive(RuntimeError):
    """Another run holds the lake's lease."""


class LeaseLost(RuntimeError):
    """Another attempt took the lease over after it had expired."""


class CheckFailure(RuntimeError):
    """Error-severity assertions failed."""


class RunLease:
    """``with RunLease(...)``: exclusive use of a lake, or RunActive.

    ``clock`` gives seconds; times of different machines are compared, so
    ``ttl`` must be well above their clocks' difference.
    """

    def __init__(self, spark: SparkSession, base: str, run: str, ttl: float = 600.0,
                 clock: Callable[[], float] = time.time):
        self.spark, self.run, self.ttl, self.clock = spark, run, ttl, clock
        self.path = f"{base.rstrip('/')}/_runs/_lease"
        self.attempt = uuid.uuid4().hex
        self._stop = threading.Event()
        self._lost = False

    def _content(self) -> str:
        return json.dumps({"run": self.run, "attempt": self.attempt, "renewed": self.clock()})

    def holder(self) -> dict | None:
        text = files.read_text(self.spark, self.path)
        if text is None:
            return None
        try:
            return json.loads(text)
        except ValueError:                                   # being written
            return {"run": "?", "attempt": "?", "renewed": self.clock()}

    def acquire(self) -> None:
        held = self.holder()
        if held is not None:
            if self.clock() - held["renewed"] < self.ttl:
                raise RunActive(f"run {held['run']} holds {self.path}")
            files.delete(self.spark, self.path)              # expired; the creation below decides who follows
        try:
            files.write_text(self.spark, self.path, self._content(), overwrite=False)
        except FileExistsError as e:
            raise RunActive(f"another run has just taken {self.path}") from e
        self.verify()                                        # file systems without an atomic creation: the last one has it

    def verify(self) -> None:
        held = self.holder()
        if self._lost or held is None or held["attempt"] != self.attempt:
            self._lost = True
            raise LeaseLost(f"the lease of run {self.run} was taken over")

    def renew(self) -> None:
        self.verify()
        files.write_text(self.spark, self.path, self._content())

    def release(self) -> None:
        held = self.holder()
        if held is not None and held["attempt"] == self.attempt:
            files.delete(self.spark, self.path)

    def _keep(self) -> None:
        while not self._stop.wait(self.ttl / 4):
            try:
                self.renew()
            except LeaseLost:
                return
            except Exception:  # noqa: BLE001 - a file system hiccup; the next renewal or verify() decides
                continue

    def __enter__(self) -> RunLease:
        self.acquire()
        self._thread = threading.Thread(target=self._keep, daemon=True)
        self._thread.start()
        return self

    def __exit__(self, *exc) -> None:
        self._stop.set()
        self._thread.join()
        self.release()


class Manifest:
    """Finished steps of one run, each with a small JSON value."""

    def __init__(self, spark: SparkSession, base: str, run: str):
        self.spark, self.path = spark, f"{base.rstrip('/')}/_runs/{run}"
        self.done = {name[1:] for name in files.names(spark, self.path) if name.startswith("_")}

    def finish(self, step: str, value=None) -> None:
        files.write_text(self.spark, f"{self.path}/_{step}", json.dumps(value, default=str))

    def value(self, step: str):
        return json.loads(files.read_text(self.spark, f"{self.path}/_{step}"))


@dataclass(frozen=True)
class Step:
    name: str
    after: tuple[str, ...]
    run: Callable[[], object]


@dataclass
class Outcome:
    done: list[str] = field(default_factory=list)
    failed: dict[str, Exception] = field(default_factory=dict)
    held_back: list[str] = field(default_factory=list)


#: Errors that another attempt cannot mend.
FINAL = (CheckFailure, LeaseLost, AnalysisException)


def attempt(run: Callable[[], object], retries: int, delay: float, pause: Callable[[float], object],
            final: tuple[type[Exception], ...] = FINAL) -> object:
    """``run()``, again after ``delay``, 2 ``delay``, ... seconds if it fails, at most ``retries`` times."""
    for k in range(retries + 1):
        try:
            return run()
        except final:
            raise
        except Exception:
            if k == retries:
                raise
            pause(delay * 2 ** k)


def run_steps(steps: Iterable[Step], workers: int = 8, retries: int = 0, delay: float = 0.0,
              pause: Callable[[float], object] = time.sleep, final: tuple[type[Exception], ...] = FINAL) -> Outcome:
    """Run the steps from driver threads, each once all it comes ``after`` are done."""
    steps = {s.name: s for s in steps}
    unknown = {a for s in steps.values() for a in s.after} - set(steps)
    if unknown:
        raise ValueError(f"steps that do not exist: {sorted(unknown)}")
    out, waiting, running = Outcome(), dict(steps), {}
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        while waiting or running:
            bad = {*out.failed, *out.held_back}
            for name in [n for n, s in waiting.items() if bad.intersection(s.after)]:
                del waiting[name]
                out.held_back.append(name)
                bad.add(name)
            for name in [n for n, s in waiting.items() if set(s.after) <= set(out.done)]:
                running[pool.submit(attempt, waiting.pop(name).run, retries, delay, pause, final)] = name
            if not running:
                if waiting and not any({*out.failed, *out.held_back}.intersection(s.after) for s in waiting.values()):
                    raise ValueError(f"steps depend on each other: {sorted(waiting)}")
                continue
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                error = future.exception()
                if error is None:
                    out.done.append(name)
                elif isinstance(error, Exception):
                    out.failed[name] = error
                else:
                    raise error
    return out
