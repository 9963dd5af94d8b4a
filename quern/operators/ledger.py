"""A ledger of deliveries, so that a task that is run again, or twice at the same time, sends nothing twice.

Records are dealt to partitions by key, so a record is in the same partition however often the job runs. A partition has an
owner, the attempt that created its owner file; an attempt that finds one waits until the owner has ended, or has been silent
for `lease` seconds and is taken to be lost, and only then creates the next owner file. The owner writes an intent under the
record's idempotency key before it sends, and what came of it after. What a former owner has settled is not sent again; what it
meant to send without settling is in doubt: if the destination can say whether it has it, it is asked, else it is sent again.

Records go in groups: the intents of a group are on the disk, by one sync, before the first of it is sent; an outcome is in the file at
once and on the disk after SYNC seconds at most. So a process that dies leaves one record that was sent and not settled, and a machine that
is lost those of the last SYNC seconds; what else of the group has an intent was not sent. A partition's records are dealt to BOOKS
journals, one after the other, so a task holds a part of what it has to know.

The folder must be a file system that all executors mount, as tasks create files there exclusively. A settled failure is tried again
by the next run of the job."""

from __future__ import annotations

import hashlib
import json
import os
import time
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import unquote, urlparse

BOOKS = 64  # journals of a partition
SYNC = 0.1


def record_id(key, record: str | None) -> str:
    """The idempotency key of a record: equal for equal content only."""
    return hashlib.sha256(f"{key}\0{record}".encode()).hexdigest()[:32]


def local_path(folder: str) -> Path:
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        raise ValueError("a ledger needs a mounted file system")
    return Path(unquote(url.path))


class Ledger:
    """The journal of one partition, held by one attempt at a time."""

    def __init__(self, folder: str, partition: int, *, lease: float = 30.0, wait: float = 0.2):
        self.base, self.partition, self.lease = local_path(folder), partition, lease
        self.base.mkdir(parents=True, exist_ok=True)
        turn = 0
        while True:
            turn += 1
            try:
                os.close(os.open(self._file("owner", turn), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
                break
            except FileExistsError:
                while not self._ended(turn):
                    time.sleep(wait)
        self.turn, self.settled, self.doubtful = turn, {}, set()
        for k in range(1, turn):
            for line in self._lines(k):
                if line["state"] == "intent":
                    self.doubtful.add(line["id"])
                elif line["state"] == "settled":
                    self.doubtful.discard(line["id"])
                    self.settled[line["id"]] = line["error"]
        self.out, self.synced = self._file("journal", turn).open("a"), time.time()

    def _file(self, kind: str, turn: int) -> Path:
        return self.base / f"{self.partition:06d}-{turn:04d}.{kind}"

    def _lines(self, turn: int) -> Iterator[dict]:
        path = self._file("journal", turn)
        for line in path.read_text().splitlines() if path.exists() else ():
            try:
                yield json.loads(line)
            except ValueError:  # the owner was lost while it wrote
                return

    def _ended(self, turn: int) -> bool:
        path = self._file("journal", turn)
        last = path if path.exists() else self._file("owner", turn)
        return time.time() - last.stat().st_mtime > self.lease or self._closed(path)

    @staticmethod
    def _closed(path: Path) -> bool:
        """Whether the last line is the end."""
        if not path.exists():
            return False
        with path.open("rb") as f:
            f.seek(max(0, f.seek(0, os.SEEK_END) - 64))
            return f.read().endswith(b'{"state": "end"}\n')

    def _note(self, *lines: str, sync: bool = True) -> None:
        self.out.write("".join(f"{{{x}}}\n" for x in lines))
        self.out.flush()
        if sync:
            os.fsync(self.out.fileno())
            self.synced = time.time()

    def once(self, key, record: str | None, send: Callable[[], None], holds: Callable[[str], bool] | None = None) -> str | None:
        """Send unless that is settled; the error, or None."""
        return self.each([(key, record)], lambda *_: send(), holds)[0]

    def each(self, rows: list[tuple], send: Callable[[object, str | None], None], holds: Callable[[str], bool] | None = None) -> list[str | None]:
        """Send those of the rows (key, record) that are not settled; for each the error, or None."""
        names = [record_id(*row) for row in rows]
        open_ = list(dict.fromkeys(x for x in names if self.settled.get(x, "") is not None))
        if open_:
            self._note(*(f'"state": "intent", "id": "{x}"' for x in open_ if holds is None or x not in self.doubtful))
        for row, name in zip(rows, names, strict=True):
            if self.settled.get(name, "") is not None:
                self.settled[name] = self._sent(row, name, send, holds)
        self._note()
        return [self.settled[x] for x in names]

    def _sent(self, row: tuple, name: str, send, holds) -> str | None:
        error = None
        if name not in self.doubtful or holds is None or not holds(name):
            try:
                send(*row)
            except Exception as e:  # the row stays undelivered and says why
                error = str(e)[:500]
        self.doubtful.discard(name)
        self._note(f'"state": "settled", "id": "{name}", "error": {json.dumps(error)}', sync=time.time() - self.synced > SYNC)
        return error

    def close(self) -> None:
        self._note('"state": "end"')
        self.out.close()


class Slots:
    """Time slots dealt to several writers under one rate: writer k of n may send at begin + (i n + k) pause."""

    def __init__(self, begin: float, pause: float, writer: int, writers: int):
        self.next, self.step = begin + writer * pause, writers * pause

    def wait(self) -> None:
        if not self.step:
            return
        now = time.time()
        if self.next < now:  # slots that went by unused are lost
            self.next += -(-(now - self.next) // self.step) * self.step
        time.sleep(max(0.0, self.next - now))
        self.next += self.step
