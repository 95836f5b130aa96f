"""Copy jobs. They run when called, once, and return tables of what happened."""

import contextlib
import datetime
import json
import os
import shutil
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..materialize import snapshot, spread_io
from ..plans.grid import split_rebase
from ..plans.indexing import unique_objects
from ..settings import MAX_TRIES
from ..sources.files import (FileRanges, batch, below, drop_staging, end_run, fetch, goes_on, local_path, made_for, new_file,
                             open_root, shared_root, upload_folder)
from .joins import join_targets
from .records import aligned_parts
from .skew import join_one

GROWN = "the source is longer than it was listed"
INITIATED = "initiated"   # its time is that of the upload
STATUS_ROWS = 64          # rows of a status file of a running copy

STATUS = pa.schema([("key", pa.string()), ("target", pa.string()), ("upload_id", pa.string()),
                    ("part_number", pa.int32()), ("n_parts", pa.int32()), ("target_size", pa.int64()),
                    ("bytes", pa.int64()), ("status", pa.string()), ("tries", pa.int32()), ("responses", pa.int32()),
                    ("error", pa.string()), ("started", pa.timestamp("us", "UTC")),
                    ("finished", pa.timestamp("us", "UTC"))])
STATUS_DDL = ("key string, target string, upload_id string, part_number int, n_parts int, target_size bigint, "
              "bytes bigint, status string, tries int, responses int, error string, started timestamp, "
              "finished timestamp")


class CopyResult(NamedTuple):
    """``parts``: one row per chunk; ``objects``: one row per target."""
    parts: DataFrame
    objects: DataFrame


def finished_chunks(statuses: DataFrame) -> DataFrame:
    """Chunks or objects that were done, as ``throughput`` and ``progress_ticks`` take them: key, bytes, started, ts."""
    done = statuses.where(F.col("status") == "done")
    return done.select("key", "bytes", "started", F.col("finished").alias("ts"))


class TransferFailed(RuntimeError):
    pass


def _is_marker(row):
    return row["key"].endswith("/") and row["target_size"] == 0


def _run(work: DataFrame, action, threads: int, label: str, status_root: str = None, keep=snapshot) -> DataFrame:
    """One status row per work row. The rows are kept, by ``keep(table, label)``, so the action isn't repeated when they are read.

    With a ``status_root`` tasks also leave the rows there while they run, STATUS_ROWS in a file. Rows are sorted and files
    are named by task and number, so a task that runs again writes the same files.
    """
    run_id = uuid.uuid4().hex[:12]

    def act(row):
        started = datetime.datetime.now(datetime.timezone.utc)
        status = action(row)
        return {**status, "started": started, "finished": datetime.datetime.now(datetime.timezone.utc)}

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        with ThreadPoolExecutor(threads) as pool:
            for rows in batches:
                rows = rows.to_pylist()
                step = STATUS_ROWS if status_root else max(1, len(rows))
                for begin in range(0, len(rows), step):
                    done = list(pool.map(act, rows[begin:begin + step]))
                    if status_root:
                        _note(done, status_root, f"{label}-{run_id}-{task:06d}-{number:06d}.json", run_id)
                        number += 1
                    yield batch(done, STATUS)

    # Kept, as it is counted before it is dealt out.
    dealt = spread_io(keep(work, f"{label}-work"))
    if status_root:
        dealt = dealt.sortWithinPartitions(*[c for c in ("key", "target", "part_number") if c in dealt.columns])
    kept = keep(dealt.mapInArrow(run, STATUS_DDL), label)
    if status_root:
        end_run(status_root, run_id)
        drop_staging(status_root)
    return kept


def _note(statuses, status_root, name, run_id):
    """Writes status rows as JSON lines, in a file that appears when it is complete."""
    with new_file(status_root, name, run_id) as out:
        for status in statuses:
            known = {c: status[c] for c in STATUS.names if status.get(c) is not None}
            out.write(json.dumps({**known, "started": status["started"].isoformat(timespec="microseconds"),
                                  "finished": status["finished"].isoformat(timespec="microseconds")}).encode() + b"\n")
        out.keep = True


def _claims(targets: DataFrame) -> DataFrame:
    """Distinct key, target, is_shared: whether another key has a target at the same path, which neither may write."""
    path = F.regexp_replace("target", r"/(\.?(/|$))*", "/")
    path = F.regexp_replace(path, r"^(\./|/)+|/$", "")
    pairs = snapshot(targets.where("target is not null").select("key", "target", path.alias("path")).distinct(), "targets")
    shared = pairs.groupBy("path").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    shared = shared.where("first <> last").select("path", F.lit(True).alias("is_shared"))
    return join_one(pairs, shared, "path").select("key", "target",
                                                  F.coalesce("is_shared", F.lit(False)).alias("is_shared"))


def _refused(row):
    if row["target"] is None:
        return "missing_target"
    return "shared_target" if row["is_shared"] else None


def check_copies(result: DataFrame, on_failure: str) -> DataFrame:
    """The status rows of a copy; with ``on_failure='fail'`` raises if one of them is a failure."""
    if on_failure not in ("report", "fail"):
        raise ValueError("on_failure is 'report' or 'fail'")
    if on_failure == "fail":
        failed = result.where("status not in ('done', 'marker', 'skipped_directory', 'partial')").limit(5).collect()
        if failed:
            raise TransferFailed("; ".join(f"{row['target']}: {row['error']}" for row in failed))
    return result


def metadata_text(objects: DataFrame) -> Column:
    """The map that ``attach_metadata`` adds, as JSON; null without one."""
    known = dict(objects.dtypes).get("metadata") == "map<string,string>"
    return (F.to_json("metadata") if known else F.lit(None).cast("string")).alias("metadata")


def metadata_of(row) -> dict:
    return {name: value for name, value in json.loads(row.get("metadata") or "{}").items() if value is not None}


def _plain_work(objects: DataFrame, targets: DataFrame) -> DataFrame:
    size = "object_size" if "object_size" in objects.columns else "size"
    if "part_number" in objects.columns:
        objects = objects.where(F.col("part_number") == 1)
    sized = unique_objects(objects.withColumn("size", F.col(size))).withColumnRenamed("size", "target_size")
    if "metadata" in objects.columns:   # of the row that gives the size, where a key is repeated
        order = [F.col(c) for c in ("mtime",) if c in objects.columns] + [F.col(size).cast("bigint").alias("size")]
        sized = sized.join(objects.groupBy("key").agg(
            F.max(F.struct(*order, metadata_text(objects))).getField("metadata").alias("metadata")), "key")
    else:
        sized = sized.withColumn("metadata", F.lit(None).cast("string"))
    return sized.join(_claims(targets), "key", "left").withColumns(
        {"part_size": F.col("target_size"), "upload_id": F.lit(None).cast("string")})


def copy_objects(objects: DataFrame, targets: DataFrame, source, dest_root: str, threads: int = 4,
                 on_failure: str = "report", status_root: str = None) -> DataFrame:
    """Copies whole objects, one row per key and target: key, target, bytes, status, tries, error, started, finished.

    Two keys with one target are both refused (``shared_target``); a key with several targets is copied to each. A
    source that has more bytes than were listed is ``interrupted``, as is one with fewer, and nothing is replaced.

    Parents are created and existing files replaced, in one step when the copy is complete; until then the bytes are
    in the staging folder of the target root. A folder marker becomes a
    directory (``marker``), a target that is a directory keeps its content (``skipped_directory``). Wrong sizes and
    errors are tried again, six times in all, and then reported as ``failed``. Bodies are streamed in pieces and never
    enter a table. ``source`` is a root URI or a reader. ``running_copy`` follows the job by its ``status_root``.
    The column ``metadata`` of :func:`attach_metadata`, if there is one, is handed to the store with each object; mounted
    roots have no place for it.
    """
    reader = FileRanges(source) if isinstance(source, str) else source
    run_id = uuid.uuid4().hex[:12]

    def copy(row):
        status = {**row, "tries": 0, "responses": 0, "bytes": 0, "part_number": 1, "n_parts": 1}
        status.pop("part_size")
        status.pop("is_shared")
        status.pop("metadata")
        if _refused(row):
            status.update(status="failed", error=_refused(row))
        elif row["target_size"] is None:
            status.update(status="failed", error="missing_size")
        else:
            try:
                check_root()
                status.update(_copy_whole(reader, row, dest_root, run_id))
            except (OSError, ValueError) as error:
                status.update(status="failed", error=str(error))
        return status

    with shared_root(dest_root) as check_root:
        result = _run(_plain_work(objects, targets), copy, threads, "copied", status_root)
        end_run(dest_root, run_id)
    return check_copies(result, on_failure).select("key", "target", "bytes", "status", "tries", "error", "started",
                                               "finished")


def _copy_whole(reader, row, dest_root, run_id):
    fs, root = open_root(dest_root)
    path = below(root, row["target"])
    if _is_marker(row):
        fs.create_dir(path, recursive=True)
        return {"status": "marker"}
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        return {"status": "skipped_directory"}
    for attempt in range(1, MAX_TRIES + 1):
        try:
            with new_file(dest_root, row["target"], run_id, metadata_of(row)) as out:
                got = fetch(reader, row["key"], 0, row["target_size"], lambda _, piece: out.write(piece), 1, 1)
                if got["status"] == "done" and goes_on(reader, row["key"], row["target_size"]):
                    got.update(status="interrupted", error=GROWN)
                out.keep = got["status"] == "done"
        except OSError as error:
            got = {"bytes": 0, "status": "failed", "error": str(error)}
        if got["status"] != "failed":
            return {**got, "tries": attempt, "responses": attempt}
    return {**got, "tries": MAX_TRIES, "responses": MAX_TRIES}


def copy_multipart(plan: DataFrame, targets: DataFrame, source, dest_root: str, run_id: str = None, threads: int = 4,
                   on_failure: str = "report", status_root: str = None) -> CopyResult:
    """Copies each chunk of a plan on its own; a target appears when all of its chunks are done.

    Chunks are written at their offsets into an unfinished file below ``.uploads``, which is renamed at the end, so no
    task ever handles more than one chunk at a time, however large an object is. The same bytes at the same place
    make retried and speculative tasks harmless.
    The target root has to be a local path or a file system that all executors mount.

    Work can be cut: a plan with some of the chunks of an object leaves it ``partial``. Calls with the same ``run_id``
    add to the same unfinished file, and :func:`publish_copies` on the union of their ``parts`` completes it. That is
    also how failed parts are sent again. ``running_copy`` follows the chunks by their ``status_root``.
    """
    chunks = snapshot(plan.select("key", "part_number", "n_parts", "input_offset", "output_offset", "part_size",
                                  F.col("object_size").alias("target_size")), "copied-plan")
    work = join_targets(chunks, _claims(targets)).withColumn("at_end", _ends(F.col("target_size")))
    return _copy_ranges(work, source, dest_root, run_id, threads, on_failure, status_root)


def copy_plan(plan: DataFrame, targets: DataFrame, source, dest_root: str, threads: int = 4,
              on_failure: str = "report", status_root: str = None) -> DataFrame:
    """Runs a whole plan: single objects as they are, multipart ones by chunk. One row per object and target.

    ``shared_target`` is judged over all ``targets``, whichever way their objects are copied.
    """
    plan = snapshot(plan, "copied-plan")
    singles = copy_objects(plan.where(~F.col("is_multipart")), targets, source, dest_root, threads, on_failure, status_root)
    many = copy_multipart(plan.where(F.col("is_multipart")), targets, source, dest_root, None, threads, on_failure, status_root)
    columns = ["key", "target", "bytes", "status", "error", "started", "finished"]
    return singles.select(*columns).unionByName(many.objects.select(*columns))


def _ends(size) -> Column:
    """Whether a chunk is the last of its source, beyond which there must be nothing."""
    return F.col("input_offset") + F.col("part_size") == size


def _copy_ranges(work, source, dest_root, run_id, threads, on_failure, status_root=None) -> CopyResult:
    if local_path(dest_root) is None:
        raise ValueError("multipart targets are written at offsets and need a mounted file system; "
                         "copy_objects writes to object stores")
    reader = FileRanges(source) if isinstance(source, str) else source
    run_id = run_id or uuid.uuid4().hex
    root = local_path(dest_root)
    work = work.withColumn("upload_id", F.md5(F.concat_ws("\n", F.lit(run_id), "target")))

    def copy(row):
        offset, place, length = row["input_offset"], row["output_offset"], row["part_size"]
        status = {name: row[name] for name in ("key", "target", "upload_id", "part_number", "n_parts", "target_size")}
        if _refused(row):
            return {**status, "bytes": 0, "status": "failed", "tries": 0, "responses": 0, "error": _refused(row)}
        try:
            below(root, row["target"])
            check_root()
            handle = _open_unfinished(root, row["upload_id"])
            try:
                status.update(fetch(reader, row["key"], offset, length,
                                    lambda done, piece: _write_at(handle, piece, place + done))
                              if length else {"bytes": 0, "status": "done", "tries": 1, "responses": 1})
                if (row["at_end"] and not _is_marker(row) and status["status"] == "done"
                        and goes_on(reader, row["key"], offset + length)):
                    status.update(status="interrupted", error=GROWN)
            finally:
                os.close(handle)
        except (OSError, ValueError) as error:
            status.update(bytes=0, status="failed", tries=0, responses=0, error=str(error))
        return status

    with shared_root(dest_root) as check_root:
        parts = _run(work, copy, threads, "copied-parts", status_root)
        return CopyResult(parts, publish_copies(parts, dest_root, threads, on_failure))


def upload_parts(parts: DataFrame) -> DataFrame:
    """One row per upload of the ``parts`` of copy calls: how many of them are done or failed, their bytes and an error. A
    part that was sent several times counts once, as done if one of them is."""
    is_done = F.col("status") == "done"
    upload = ["key", "target", "upload_id"]
    one_each = parts.groupBy(*upload, "part_number").agg(
        F.max(is_done).alias("done"), F.max(F.when(is_done, F.col("bytes"))).alias("bytes"),
        F.max("n_parts").alias("n_parts"), F.max("target_size").alias("target_size"), F.max("error").alias("error"),
        F.sum("responses").alias("responses"))
    return one_each.groupBy(*upload).agg(
        F.max("n_parts").alias("n_parts"), F.max("target_size").alias("target_size"),
        F.coalesce(F.sum("bytes"), F.lit(0).cast("bigint")).alias("bytes"),
        F.count(F.when(F.col("done"), 1)).cast("int").alias("done_parts"),
        F.count(F.when(~F.col("done"), 1)).cast("int").alias("failed_parts"),
        F.max(F.when(~F.col("done"), F.col("error"))).alias("error"),
        F.sum("responses").cast("int").alias("responses"))


def publish_copies(parts: DataFrame, dest_root: str, threads: int = 4, on_failure: str = "report") -> DataFrame:
    """Makes targets visible whose parts are all done, given the ``parts`` of one or more copy calls of one run.

    key, target, upload_id, n_parts, bytes, status, error, started, finished. ``partial`` means that nothing failed but
    parts are missing. A part that was sent again counts once.
    """
    root = local_path(dest_root)

    def publish(row):
        row.pop("part_size")
        done, failed = row.pop("done_parts"), row.pop("failed_parts")
        status = {**row, "tries": 1, "part_number": row["n_parts"]}
        try:
            if done == row["n_parts"] and row["bytes"] == row["target_size"]:
                status.update(error=None)
                status.update(_publish(root, row))
            elif failed:
                status.update(status="interrupted" if row["error"] == GROWN else "failed")
            else:
                status.update(status="partial", error=f"{done} of {row['n_parts']} parts")
        except (OSError, ValueError) as error:
            status.update(status="failed", error=str(error))
        return status

    whole = upload_parts(parts).withColumn("part_size", F.lit(0).cast("bigint"))
    objects = _run(whole, publish, threads, "published")
    drop_staging(dest_root)
    objects = check_copies(objects, on_failure)
    return objects.select("key", "target", "upload_id", "n_parts", "bytes", "status", "error", "started", "finished")


def _staging(root, upload_id):
    return os.path.join(root, upload_folder(upload_id))


def _unfinished(root, upload_id):
    return os.path.join(_staging(root, upload_id), "body")


def _open_unfinished(root, upload_id):
    """Opens the unfinished file of an upload. The first call makes its staging folder, with a file that keeps the time; so
    where there is an unfinished file, the time has been kept."""
    unfinished = _unfinished(root, upload_id)
    with contextlib.suppress(FileNotFoundError):
        return os.open(unfinished, os.O_WRONLY)
    staging = _staging(root, upload_id)
    with contextlib.suppress(FileExistsError):
        made_for(staging, lambda: open(os.path.join(staging, INITIATED), "x")).close()
    return os.open(unfinished, os.O_CREAT | os.O_WRONLY, 0o644)


def _end_upload(root, upload_id):
    """Removes the staging folder of an upload, which as a rule holds the file with the time only."""
    staging = _staging(root, upload_id)
    try:
        os.unlink(os.path.join(staging, INITIATED))
        os.rmdir(staging)
    except OSError:
        shutil.rmtree(staging, ignore_errors=True)


def _write_at(handle, piece, position):
    view = memoryview(piece)
    while len(view):
        written = os.pwrite(handle, view, position)
        view, position = view[written:], position + written


def _publish(root, row):
    path, unfinished = below(root, row["target"]), _unfinished(root, row["upload_id"])
    if _is_marker(row):
        os.makedirs(path, exist_ok=True)
        _end_upload(root, row["upload_id"])
        return {"status": "marker"}
    try:
        size = os.stat(unfinished).st_size
    except FileNotFoundError:
        # A task that was run again after it had renamed the file.
        if os.path.isfile(path) and os.path.getsize(path) == row["target_size"]:
            return {"status": "done"}
        return {"status": "failed", "error": "the unfinished file is gone"}
    if size > row["target_size"]:
        os.truncate(unfinished, row["target_size"])
    elif size < row["target_size"]:
        return {"status": "interrupted", "error": "size of the written file differs"}
    made_for(os.path.dirname(path), lambda: os.replace(unfinished, path))
    _end_upload(root, row["upload_id"])
    return {"status": "done"}


def write_split(assigned: DataFrame, n_nodes: int, source, dest_root: str, boundaries: DataFrame = None,
                chunk_size: int = None, run_id: str = None, threads: int = 4,
                on_failure: str = "report") -> CopyResult:
    """Each node gets its slice of an object as a file of the same name: ``node=<k>/<key>``.

    Without ``boundaries`` the slices are those of the plan; with the record-aligned ranges of ``fastq_boundaries`` no
    record is cut. In the order of the nodes the files are the source. Slices are copied as byte ranges: no records
    are read, and a slice is written by as many tasks as it has chunks.
    """
    if boundaries is None:
        work = split_rebase(assigned, n_nodes).select(
            "key", "node", "part_number", F.col("node_parts").alias("n_parts"), "input_offset", "output_offset",
            "part_size", F.col("node_size").alias("target_size"), _ends(F.col("object_size")).alias("at_end"))
    else:
        work = aligned_parts(boundaries, chunk_size).select(
            "key", "node", "part_number", F.col("node_parts").alias("n_parts"), "input_offset", "output_offset",
            "part_size", F.col("node_size").alias("target_size"), F.lit(False).alias("at_end"))
    target = F.concat(F.lit("node="), F.col("node").cast("string"), F.lit("/"), F.col("key"))
    # The node and the key are in the target, so no two keys share one.
    return _copy_ranges(work.withColumns({"target": target, "is_shared": F.lit(False)}).drop("node"), source, dest_root, run_id, threads,
                        on_failure)


def write_objects(objects: DataFrame, dest_root: str) -> DataFrame:
    """Writes bodies held in a table as files below a root: key, bytes, status. Files appear when they are complete.

    Keys don't repeat, and the executors share the root.
    """
    run_id = uuid.uuid4().hex[:12]

    def write(batches):
        check_root()
        fs, root = open_root(dest_root)
        for rows in batches:
            written = []
            for key, body in zip(rows.column("key").to_pylist(), rows.column("body").to_pylist()):
                if key.endswith("/") and not body:
                    fs.create_dir(below(root, key), recursive=True)
                else:
                    with new_file(dest_root, key, run_id) as out:
                        out.write(body)
                        out.keep = True
                written.append({"key": key, "bytes": len(body), "status": "done"})
            yield pa.RecordBatch.from_pylist(written, schema=pa.schema(
                [("key", pa.string()), ("bytes", pa.int64()), ("status", pa.string())]))

    bodies = objects.select("key", F.col("body").cast("binary").alias("body"))
    with shared_root(dest_root) as check_root:
        written = snapshot(bodies.mapInArrow(write, "key string, bytes bigint, status string"), "written")
        end_run(dest_root, run_id)
    return written
