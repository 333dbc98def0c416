"""Plans of file operations carried out once, whatever tasks are lost, run twice or run again."""

from __future__ import annotations

import contextlib
import errno
import filecmp
import json
import os
import re
import shutil
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..shared import opened, written
from .state import Folder

col, lit = F.col, F.lit
ROW = "op string, src string, dst string, value string, begun boolean"
LINE = "what string, op string, src string, dst string, error string"


def _local(path: str | None) -> str | None:
    return path and re.sub("^file:/*", "/", path)


def _appear(make: Callable[[str], None], dst: str) -> None:
    """``dst`` as ``make`` writes it: whole, and only if there is none."""
    os.makedirs(os.path.dirname(dst) or ".", exist_ok=True)
    mine = f"{dst}.{uuid.uuid4().hex}.part"
    try:
        make(mine)
        os.link(mine, dst)
    finally:
        if os.path.exists(mine):
            os.unlink(mine)


def _move(src: str, dst: str) -> None:
    os.makedirs(os.path.dirname(dst) or ".", exist_ok=True)
    try:
        os.link(src, dst)
    except FileExistsError:
        if not os.path.samefile(src, dst):  # else somebody was stopped between the two names
            raise
    except OSError as e:
        if e.errno != errno.EXDEV:
            raise
        _appear(lambda mine: shutil.copyfile(src, mine), dst)
    with contextlib.suppress(FileNotFoundError):  # another attempt has just done it
        os.unlink(src)


def file_operation(op: str, src: str, dst: str | None, value: str | None, begun: bool) -> None:
    """copy, move, rename, delete or sidecar (``value`` written to ``dst``) of files that executors share.

    Done again, or by two at once, it does no more than once. A target that is
    there is an error, unless it is what this operation would make; a source
    that is gone is one too, unless the operation was ``begun`` before.
    """
    src, dst = _local(src), _local(dst)
    if op == "copy":
        try:
            if os.path.exists(dst):
                raise FileExistsError(errno.EEXIST, "target exists", dst)
            _appear(lambda mine: shutil.copyfile(src, mine), dst)
        except FileExistsError:
            if not filecmp.cmp(src, dst, shallow=False):
                raise
    elif op in ("move", "rename"):
        try:
            _move(src, dst)
        except FileNotFoundError:
            if not begun or os.path.exists(src) or not os.path.exists(dst):
                raise
    elif op == "delete":
        try:
            os.unlink(src)
        except FileNotFoundError:
            if not begun:
                raise
    elif op == "sidecar":
        os.makedirs(os.path.dirname(dst) or ".", exist_ok=True)
        mine = f"{dst}.{uuid.uuid4().hex}.part"
        with open(mine, "w", encoding="utf-8") as f:
            f.write(value or "")
        os.replace(mine, dst)
    elif op not in ("keep", "skip"):
        raise ValueError(f"no operation: {op}")


@dataclass
class Journal(WriterCommitMessage):
    """What a task that succeeded hands in: the name of its journal."""

    name: str


class _Writer(DataSourceWriter):
    def __init__(self, folder: str, job: str, act: Callable):
        self.folder, self.job, self.act = folder, job, act

    def _open(self):
        from pyarrow import fs

        system, at = opened(self.folder)
        system.create_dir(at, recursive=True)
        return fs, system, at

    def write(self, iterator: Iterator) -> Journal:
        fs, system, at = self._open()
        part = f"{self.job}-{TaskContext.get().partitionId()}-"
        name = f"{part}{uuid.uuid4().hex}.json"

        def attempts() -> tuple[set, set]:
            """What other attempts of this task have begun, and done."""
            begun, done = set(), set()
            for e in system.get_file_info(fs.FileSelector(at)):
                if e.base_name.startswith(part) and e.base_name != name:
                    for line in system.open_input_stream(e.path).read().decode().split("\n"):
                        try:
                            row = json.loads(line)
                        except ValueError:  # the end of a file whose writer was killed, or writes just now
                            continue
                        {"begin": begun, "done": done}.get(row["what"], set()).add((row["op"], row["src"], row["dst"]))
            return begun, done

        begun, done = attempts()
        out = system.open_output_stream(f"{at}/{name}")

        def say(what: str, key: tuple, error: str | None = None) -> None:
            out.write((json.dumps(dict(zip(("what", "op", "src", "dst", "error"), (what, *key, error), strict=True))) + "\n").encode())
            out.flush()

        def act(r, key: tuple) -> None:
            try:
                self.act(*key, r.value, r.begun or key in begun)
            except FileNotFoundError:  # perhaps an attempt that runs beside this one was faster; what it begins it has said before
                if key not in attempts()[0]:
                    raise
                self.act(*key, r.value, True)

        for r in iterator:
            key = (r.op, r.src, r.dst)
            if key not in done:
                try:
                    say("begin", key)
                    act(r, key)
                except Exception as e:  # one file's failure is its row's error
                    say("error", key, f"{type(e).__name__}: {e}")
                    continue
            say("done", key)
        out.close()
        return Journal(name)

    def commit(self, messages: list[Journal | None]) -> None:
        _, system, at = self._open()
        with system.open_output_stream(f"{at}/committed-{self.job}") as f:
            f.write(json.dumps([m.name for m in messages if m is not None]).encode())

    def abort(self, messages: list[Journal | None]) -> None:
        """Journals stay: the next run reads what was done."""


def _said(plan: DataFrame, journal: str) -> DataFrame:
    spark = plan.sparkSession
    names = [n for n in Folder(spark, journal).names() if n.endswith(".json")]
    if not names:
        return spark.createDataFrame([], LINE)
    return spark.read.schema(LINE).option("mode", "DROPMALFORMED").option("pathGlobFilter", "*.json").json(journal)


def carry_out(plan: DataFrame, journal: str, act: Callable = file_operation) -> DataFrame:
    """``op, src, dst, error`` of each different row of ``plan`` (op, src, dst and, for sidecars, value), carried out once.

    ``journal`` is a folder that executors share. A task writes what it begins
    and what is done there, line by line; its next attempt, and a later run with
    the same journal, leave out what is done, and know what was begun. The rows
    that come back are those of the tasks whose journals were handed in with the
    commit, so a copy of a task that runs beside it adds none. What failed has its
    reason and is tried again by the next run. ``act(op, src, dst, value, begun)``
    must bear to be run beside itself, as :func:`file_operation` does.
    """
    spark, job = plan.sparkSession, uuid.uuid4().hex
    rows = plan.select("op", "src", "dst", col("value") if "value" in plan.columns else lit(None).cast("string").alias("value")).dropDuplicates(["op", "src", "dst"])
    said = written(_said(plan, journal).groupBy("op", "src", "dst").agg(F.bool_or(col("what") == "done").alias("done")))
    same = [col(c).eqNullSafe(col(f"_{c}")) for c in ("op", "src", "dst")]
    marked = rows.join(said.toDF("_op", "_src", "_dst", "_done"), same, "left")
    before = written(marked.where("_done").select("op", "src", "dst", lit(None).cast("string").alias("error")))

    class Plan(DataSource):
        @classmethod
        def name(cls) -> str:
            return "file_plan"

        def schema(self) -> str:
            return ROW

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return _Writer(journal, job, act)

    spark.dataSource.register(Plan)
    todo = marked.where("_done is null or not _done").select("op", "src", "dst", "value", col("_done").isNotNull().alias("begun"))
    todo.write.format("file_plan").mode("append").save()
    names = json.loads(Folder(spark, journal).read(f"committed-{job}"))
    if not names:
        return before
    now = spark.read.schema(LINE).json([f"{journal.rstrip('/')}/{n}" for n in names])
    return before.unionByName(now.where("what <> 'begin'").select("op", "src", "dst", "error"))
