"""Tables as immutable versions behind a pointer that is swapped atomically.

A root folder holds data/<id> (Parquet, written once and never changed) and log/<number>.json: the pointer is the entry of the
highest number, which names its data. A writer first writes its data, then claims the next number; of two writers that read the same
number only one gets it, the other is refused and its data stays unnamed. A reader reads the pointer once and then only files that nobody changes; a crash
before the claim leaves the pointer as it was.

A number is claimed by an operation that fails if its name exists: a hard link on local file systems, a rename on others, which HDFS and file
systems like it refuse for a name that is taken. On object stores without such a rename, use a table format with its own commit service.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from .tables import fingerprint


class PublishError(ValueError):
    """A version is not published: the pointer has moved, or a check failed."""


def _fs(spark: SparkSession, root: str):
    """(the JVM, the file system of root, its Path class)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    return jvm, path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _entries(spark: SparkSession, root: str) -> dict[int, str]:
    """The log: its numbers, and their files."""
    _, fs, path = _fs(spark, root)
    log = path(f"{root}/log")
    if not fs.exists(log):
        return {}
    names = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(log)]
    return {int(n[:-5]): p for n, p in names if n.endswith(".json") and n[:-5].isdigit()}


def _entry(spark: SparkSession, file: str) -> dict:
    """What an entry of the log says: one small file."""
    return json.loads(spark.read.text(file, wholetext=True).first()[0])


def _claimed(spark: SparkSession, text: str, root: str, number: int) -> bool:
    """Whether the log's entry of this number is now this text; false if another has it."""
    jvm, fs, path = _fs(spark, root)
    new, name = path(f"{root}/log/.{uuid.uuid4().hex}"), path(f"{root}/log/{number:020d}.json")
    out = fs.create(new, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            try:
                jvm.java.nio.file.Files.createLink(*[fs.pathToFile(p).toPath() for p in (name, new)])
                return True
            except Exception as error:
                if "FileAlreadyExistsException" in str(error):
                    return False
                raise
        return not fs.exists(name) and bool(fs.rename(new, name))
    finally:
        if fs.exists(new):
            fs.delete(new, False)


def current(spark: SparkSession, root: str) -> dict | None:
    """The pointer: number, data, rows and fingerprint of the version that readers get; none before the first."""
    found = _entries(spark, root)
    if not found:
        return None
    number = max(found)
    return _entry(spark, found[number]) | {"number": number}


def read_version(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The table as the pointer has it, or as it was in that version."""
    found = _entries(spark, root)
    number = max(found, default=None) if number is None else number
    if number not in found:
        raise PublishError(f"{root} has no version {number}")
    entry = _entry(spark, found[number])
    return spark.read.parquet(f"{root}/{entry['data']}")


def staged_version(df: DataFrame, root: str) -> dict:
    """df written as data that no version names yet: what swap() takes."""
    data = f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{data}")
    n_rows, hash_xor, hash_sum = fingerprint(df.sparkSession.read.parquet(f"{root}/{data}")).first()
    return {"data": data, "rows": n_rows, "fingerprint": [n_rows, hash_xor, str(hash_sum)]}


def swap(spark: SparkSession, root: str, seen: int | None, version: dict) -> int:
    """Points readers to the version if the pointer is still what was seen (none: no version yet). Its number."""
    now = max(_entries(spark, root), default=None)
    if now != seen:
        raise PublishError(f"{root} is at version {now}, not {seen}")
    number = 1 if seen is None else seen + 1
    if not _claimed(spark, json.dumps({k: v for k, v in version.items() if k != "number"}), root, number):
        raise PublishError(f"{root} got version {number} from another writer")
    return number


def publish(df: DataFrame, root: str, seen: int | None) -> int:
    """df as the next version, if the pointer is still what was seen."""
    spark = df.sparkSession
    now = max(_entries(spark, root), default=None)
    if now != seen:  # before a large table is written in vain
        raise PublishError(f"{root} is at version {now}, not {seen}")
    return swap(spark, root, seen, staged_version(df, root))


def guarded_publish(candidate: DataFrame, root: str, reviewed_version: int, reviewed_candidate: tuple, violations: int = 0) -> int:
    """Publishes the candidate if nothing was overwritten, the pointer is still the version that was reviewed, and what was written is the candidate that was reviewed (its fingerprint)."""
    if violations:
        raise PublishError(f"{violations} overwrite violations")
    spark = candidate.sparkSession
    now = max(_entries(spark, root), default=None)
    if now != reviewed_version:
        raise PublishError(f"the active table is at version {now}, not {reviewed_version} as reviewed")
    version = staged_version(candidate, root)
    want = [reviewed_candidate[0], reviewed_candidate[1], str(reviewed_candidate[2])]
    if version["fingerprint"] != want:
        raise PublishError("the candidate table is not the one reviewed")
    return swap(spark, root, reviewed_version, version)


def restored(spark: SparkSession, root: str, number: int) -> int:
    """Points readers to an earlier version's data again, as a new version."""
    found = _entries(spark, root)
    if number not in found:
        raise PublishError(f"{root} has no version {number}")
    return swap(spark, root, max(found), _entry(spark, found[number]))


def swept(spark: SparkSession, root: str, keep: int, pending: tuple[str, ...] = ()) -> int:
    """Deletes all but the last `keep` versions, and data that no kept version names, but for pending (of writers that still run). How many folders went."""
    _, fs, path = _fs(spark, root)
    found = _entries(spark, root)
    kept = sorted(found)[-max(1, keep) :]
    named = {_entry(spark, found[n])["data"] for n in kept} | set(pending)
    for n in set(found) - set(kept):
        fs.delete(path(found[n]), False)
    folder = path(f"{root}/data")
    loose = [s.getPath() for s in fs.listStatus(folder) if f"data/{s.getPath().getName()}" not in named] if fs.exists(folder) else []
    for p in loose:
        fs.delete(p, True)
    return len(loose)
