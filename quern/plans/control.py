"""Runs at three levels of thoroughness as graphs of steps, with a kill switch that also ends running work, and gates on deletions."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path


class Control:
    """A small JSON file of switches on the driver, replaced whole on every write."""

    def __init__(self, path: str):
        self.path = Path(path)
        if not self.path.exists():
            self._save({})

    def _save(self, values: dict) -> None:
        handle, name = tempfile.mkstemp(dir=self.path.parent)
        with os.fdopen(handle, "w") as out:
            json.dump(values, out)
        os.replace(name, self.path)

    def get(self, name: str):
        return json.loads(self.path.read_text()).get(name)

    def set(self, name: str, value) -> None:
        self._save(json.loads(self.path.read_text()) | {name: value})


@dataclass(frozen=True)
class Level:
    """What a run may do; None is no bound."""

    pull_most: int | None
    comment_pages: int | None
    text_pages: int | None
    deletions: bool
    retry_missing: bool


LEVELS = {1: Level(48, 5, 4, False, False), 2: Level(None, 10, None, True, False), 3: Level(None, None, None, True, True)}


class Stopped(Exception):
    """The kill switch went off before a step, or in it."""


def run_steps(control: Control, level: int, steps: list[tuple[str, Callable[[Level], object]]], *, switch: str = "jobs") -> dict[str, object]:
    """Run the steps in order, checking the switches before each. A step that fails is recorded and the next one runs."""
    results: dict[str, object] = {}
    for name, step in steps:
        if control.get(switch) is False or control.get("everything") is False:
            control.set(switch, True)  # the job's own switch is ready for its next run; the global one stays off
            raise Stopped(name)
        try:
            results[name] = step(LEVELS[level])
        except Exception as e:  # reported with the run, as one broken source should not hold up the others
            results[name] = e
    return results


def run_graph(control: Control, level: int, steps: list[tuple[str, Callable[[Level], object], tuple[str, ...]]], context, *, switch: str = "jobs", at_once: int = 4, poll: float = 0.5) -> dict[str, object]:
    """Run steps (name, step, names of the steps before it), those that wait for nothing at the same time, each in a scheduler pool of its
    own name (pools matter where the context schedules fairly). A step that fails is recorded and what follows it runs.

    The switches are read every `poll` seconds. When one goes off no step begins, the Spark jobs of the running ones are cancelled by their
    tag, and Stopped is raised when these have ended. Stores are as they were, as a commit appears at its end or not at all."""
    import uuid
    from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

    run, results, waiting, running = uuid.uuid4().hex[:12], {}, {n: set(after) for n, _, after in steps}, {}
    work = {n: step for n, step, _ in steps}
    unknown = {a for after in waiting.values() for a in after} - set(work)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")

    def one(name: str) -> object:
        context.addJobTag(f"{run}-{name}")
        context.setLocalProperty("spark.scheduler.pool", name)
        try:
            return work[name](LEVELS[level])
        finally:
            context.removeJobTag(f"{run}-{name}")

    def collect(done: set[Future]) -> None:
        for f in done:
            name = running.pop(f)
            results[name] = f.exception() or f.result()
            for after in waiting.values():
                after.discard(name)

    def stopped() -> bool:
        return control.get(switch) is False or control.get("everything") is False

    with ThreadPoolExecutor(at_once) as pool:
        while waiting or running:
            if stopped():
                names = [*running.values(), *waiting]
                while running:
                    for name in running.values():
                        context.cancelJobsWithTag(f"{run}-{name}")
                    collect(wait(running, timeout=poll).done)
                control.set(switch, True)  # the job's own switch is ready for its next run; the global one stays off
                raise Stopped(names[0])
            for name in [n for n, after in waiting.items() if not after][: at_once - len(running)]:
                del waiting[name]
                running[pool.submit(one, name)] = name
            if not running:
                raise ValueError(f"steps wait for each other: {sorted(waiting)}")
            collect(wait(running, timeout=poll, return_when=FIRST_COMPLETED).done)
    return {n: results[n] for n, _, _ in steps}


def may_delete(level: Level, *, pull_ok: bool, ids_ok: bool, full: bool) -> bool:
    return level.deletions and pull_ok and ids_ok and full


# ---- schedules and switches ----

#: The three jobs, their level and how often they run.
JOBS = {"frequent": 1, "daily": 2, "weekly": 3}


class Schedule:
    """Runs jobs when they are due, one at a time, until it is told to stop. A job is due when its cron-like rule (any function of
    the time that says yes) holds and it has not run in this minute."""

    def __init__(self, control: Control, jobs: dict[str, tuple[Callable[[float], bool], Callable[[], object]]], *, clock: Callable[[], float], sleep: Callable[[float], None], switches=("jobs", "everything")):
        self.control, self.jobs, self.clock, self.sleep, self.switches = control, jobs, clock, sleep, switches
        self.last: dict[str, int] = {}
        self.stopping = False

    def stop(self, *_) -> None:
        """Both switches off; the running job stops before its next step. Also the handler of a termination signal."""
        for name in self.switches:
            self.control.set(name, False)
        self.stopping = True

    def handle_signals(self) -> None:
        import signal

        signal.signal(signal.SIGTERM, self.stop)

    def tick(self) -> list[str]:
        """Run what is due now; the names of the jobs that ran."""
        now, ran = self.clock(), []
        for name, (due, job) in self.jobs.items():
            if not self.stopping and due(now) and self.last.get(name) != int(now // 60):
                self.last[name] = int(now // 60)
                try:
                    job()
                except Stopped:
                    pass
                ran.append(name)
        return ran

    def run(self, pause: float = 5.0) -> None:
        while not self.stopping and self.control.get("everything") is not False:
            self.tick()
            self.sleep(pause)


def run_stamp(now: float) -> str:
    """The name of a run: %Y%m%d-%H%M in UTC."""
    import time as clock

    return clock.strftime("%Y%m%d-%H%M", clock.gmtime(now))


def main(arguments: list[str], run_once: Callable[[int], object] | None = None) -> str:
    """Command line over a control file: `<file> stop | disable | enable | once`."""
    control, command = Control(arguments[0]), arguments[1]
    if command == "stop":
        control.set("jobs", False)
        control.set("everything", False)
    elif command in ("disable", "enable"):
        control.set("jobs", command == "enable")
    elif command == "once" and run_once is not None:
        control.set("jobs", True)
        run_once(1)
    else:
        raise SystemExit(f"unknown command {command}")
    return f"jobs={control.get('jobs')} everything={control.get('everything')}"


if __name__ == "__main__":
    import sys

    print(main(sys.argv[1:]))
