"""Publication of several tables at once: versions in folders of their own, and one pointer that is replaced atomically."""

from __future__ import annotations

import contextlib
import fcntl
import json
import os
import re
import shutil
import time
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"
JOURNAL = "JOURNAL"


class Pending(RuntimeError):
    """An unfinished publication blocks the collection until it is recovered."""


@contextlib.contextmanager
def single_writer(root: str) -> Iterator[None]:
    """An exclusive lock on the collection; a second writer is refused at once."""
    Path(root).mkdir(parents=True, exist_ok=True)
    with open(Path(root, ".lock"), "w") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except OSError as e:
            raise Pending("another writer holds the collection") from e
        yield


def write_text(path: Path, text: str) -> None:
    """Replaces a file in one step, on disk before its name changes."""
    temporary = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    with open(temporary, "w") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    os.replace(temporary, path)


def current(root: str) -> str | None:
    """Name of the published version; refuses while a publication is unfinished."""
    if Path(root, JOURNAL).exists():
        raise Pending("recover the collection first")
    pointer = Path(root, POINTER)
    return json.loads(pointer.read_text())["version"] if pointer.exists() else None


def publish(root: str, tables: dict[str, DataFrame]) -> str:
    """Writes all tables as a new version and points to it; a failure leaves the old version current."""
    with single_writer(root):
        previous = current(root)
        version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        write_text(Path(root, JOURNAL), json.dumps({"version": version, "previous": previous}))
        try:
            for name, table in tables.items():
                if not re.fullmatch(r"[A-Za-z0-9_]+", name):
                    raise ValueError(f"table name: {name}")
                table.write.mode("errorifexists").parquet(str(Path(root, "versions", version, name)))
            write_text(Path(root, POINTER), json.dumps({"version": version, "previous": previous, "committed": time.time()}))
        except BaseException:
            recover_unlocked(root)
            raise
        Path(root, JOURNAL).unlink()
        return version


def recover(root: str) -> str:
    """Finishes or undoes what the journal says: 'clean', 'finished' or 'rolled_back'. Repeating it changes nothing."""
    with single_writer(root):
        return recover_unlocked(root)


def recover_unlocked(root: str) -> str:
    journal = Path(root, JOURNAL)
    if not journal.exists():
        return "clean"
    version = json.loads(journal.read_text())["version"]
    pointer = Path(root, POINTER)
    done = pointer.exists() and json.loads(pointer.read_text())["version"] == version
    if not done:
        shutil.rmtree(Path(root, "versions", version), ignore_errors=True)
    journal.unlink()
    return "finished" if done else "rolled_back"


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    version = current(root)
    if version is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return spark.read.parquet(str(Path(root, "versions", version, name)))


def prune(root: str, keep: int) -> list[str]:
    """Removes all but the newest ``keep`` versions; the current one always stays. Gives the names removed."""
    with single_writer(root):
        now = current(root)
        names = sorted((p.name for p in Path(root, "versions").iterdir()), reverse=True) if Path(root, "versions").exists() else []
        gone = [n for n in names[max(0, keep) :] if n != now]
        for n in gone:
            shutil.rmtree(Path(root, "versions", n))
        return gone
