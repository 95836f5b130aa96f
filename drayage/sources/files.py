"""Small helpers that open, list and write files inside tasks."""

import contextlib
import os
import re
import uuid

import pyarrow as pa
import pyarrow.fs as pafs

from ..settings import MAX_RESPONSES_PER_TRY, MAX_TRIES, STAGING_DIR

PIECE = 8 << 20


def local_path(uri: str):
    """Path of a local or mounted root, or None for a remote one."""
    if uri.startswith("file://"):
        return uri[len("file://"):].rstrip("/") or "/"
    if uri.startswith("file:"):
        return uri[len("file:"):].rstrip("/") or "/"
    if "://" in uri:
        return None
    return os.path.abspath(uri)


def open_root(uri: str):
    """(filesystem, path of the root) for any URI that pyarrow or a mount can serve."""
    path = local_path(uri)
    if path is not None:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri.rstrip("/")))


def spark_path(uri: str) -> str:
    """The same root as Spark names it: its S3 connector has a scheme of its own."""
    return re.sub("^s3n?://", "s3a://", uri)


def below(root: str, relative: str) -> str:
    """``root/relative``, refused if it leaves the root."""
    clean = os.path.normpath("/" + relative).lstrip("/")
    if clean != os.path.normpath(relative.lstrip("/") or ".") or ".." in relative.split("/"):
        raise ValueError(f"path leaves the root: {relative}")
    return os.path.join(root, clean)


class _Unfinished:
    def __init__(self, stream):
        self.write = stream.write
        self.keep = False


@contextlib.contextmanager
def new_file(root_uri: str, relative: str, run_id: str, metadata: dict = None):
    """A file that appears below the root, replacing what was there, only if ``keep`` is set when it is closed.

    Each attempt writes to a name of its own in a staging folder of its process, so killed and speculative tasks leave nothing in
    the tree. Object stores show an object when its stream is closed, also after an error, so the name is a key of its
    own there too, and the object is moved when it is complete. ``metadata`` goes to the object there; files have none.
    """
    root = local_path(root_uri)
    if root is None:
        fs, path = open_root(root_uri)
        target, unfinished = below(path, relative), f"{path}/{STAGING_DIR}/{run_id}/{uuid.uuid4().hex}"
        keep = False
        try:
            fs.create_dir(os.path.dirname(unfinished), recursive=True)
            with fs.open_output_stream(unfinished, metadata=metadata or None) as stream:
                out = _Unfinished(stream)
                yield out
            keep = out.keep
        finally:
            if keep:
                fs.create_dir(os.path.dirname(target), recursive=True)
                fs.move(unfinished, target)
            elif fs.get_file_info(unfinished).type != pafs.FileType.NotFound:
                fs.delete_file(unfinished)
        return
    path, staging = below(root, relative), os.path.join(root, STAGING_DIR, run_id, _worker())
    unfinished, moved = os.path.join(staging, uuid.uuid4().hex), False
    try:
        with made_for(staging, lambda: open(unfinished, "wb")) as stream:
            out = _Unfinished(stream)
            yield out
        if out.keep:
            made_for(os.path.dirname(path), lambda: os.replace(unfinished, path))
            moved = True
    finally:
        if not moved:
            with contextlib.suppress(FileNotFoundError):
                os.unlink(unfinished)


_workers = {}


def _worker() -> str:
    """Name of this process. Each has a staging folder of its own: a folder takes one new name at a time, and processes that
    share one wait for each other, the longer the more there are."""
    return _workers.setdefault(os.getpid(), f"worker-{uuid.uuid4().hex}")


def made_for(folder: str, action):
    """What ``action`` returns, with the folder it needs made only if it turns out to be missing."""
    try:
        return action()
    except FileNotFoundError:
        os.makedirs(folder, exist_ok=True)
        return action()


def end_run(root_uri: str, run_id: str):
    """Removes the staging folder of a run if nothing is left in it."""
    root = local_path(root_uri)
    if root is not None:
        _drop_empty(os.path.join(root, STAGING_DIR, run_id), "worker-")


def _drop_empty(folder: str, prefix: str):
    """Removes a folder, and those in it whose names start so, as far as they are empty."""
    with contextlib.suppress(OSError):
        for name in os.listdir(folder):
            if name.startswith(prefix):
                with contextlib.suppress(OSError):
                    os.rmdir(os.path.join(folder, name))
        os.rmdir(folder)


@contextlib.contextmanager
def shared_root(root_uri: str):
    """Yields a check for tasks: whether a mounted root is the folder that the driver sees, not a local one of theirs.

    The driver leaves a token in the staging folder, and removes it when the job is over.
    """
    root = local_path(root_uri)
    if root is None:
        yield lambda: None
        return
    token = os.path.join(root, STAGING_DIR, f"shared-{uuid.uuid4().hex}")
    made_for(os.path.dirname(token), lambda: open(token, "x")).close()

    def check():
        if not os.path.exists(token):
            raise OSError(f"the executors don't share the target root: {root}")

    try:
        yield check
    finally:
        with contextlib.suppress(FileNotFoundError):
            os.unlink(token)
        drop_staging(root_uri)


def drop_staging(root_uri: str):
    """Removes the staging folder if nothing is in it: no unfinished upload, and no token of a running job."""
    root = local_path(root_uri)
    if root is not None:
        staging = os.path.join(root, STAGING_DIR)
        with contextlib.suppress(OSError):
            if all(re.fullmatch(SHARD, name) for name in os.listdir(staging)):
                _drop_empty(staging, "")


SHARD = "[0-9a-f]{2}"


def upload_folder(upload_id: str) -> str:
    """Where the unfinished parts of an upload are, below the target root. Uploads are dealt out to folders by the first two
    digits of their ids: one folder of all uploads makes tasks wait for each other."""
    return f"{STAGING_DIR}/{upload_id[:2]}/{upload_id}"


def fetch(reader, key, offset, length, write, max_responses=MAX_RESPONSES_PER_TRY, max_tries=MAX_TRIES):
    """Reads a range into ``write(position, bytes)``: resumes short responses, starts over after errors."""
    responses, error = 0, None
    for attempt in range(1, max_tries + 1):
        done = 0
        try:
            for _ in range(max_responses):
                responses += 1
                for piece in reader.read(key, offset + done, length - done):
                    write(done, piece)
                    done += len(piece)
                if done == length:
                    return {"bytes": done, "status": "done", "tries": attempt, "responses": responses}
            error = f"{done} of {length} bytes after {max_responses} responses"
        except (OSError, pa.ArrowException, ValueError) as failure:
            error = str(failure)
    return {"bytes": done, "status": "failed", "tries": max_tries, "responses": responses, "error": error}


def read_fully(reader, key, offset, length) -> bytes:
    """The bytes of a range, by the rules of :func:`fetch`; raises OSError if they can't be had completely."""
    body = bytearray(length)

    def write(position, piece):
        body[position:position + len(piece)] = piece

    got = fetch(reader, key, offset, length, write) if length else {"status": "done"}
    if got["status"] != "done":
        raise OSError(f"{key} at {offset}: {got['error']}")
    return bytes(body)


def goes_on(reader, key, size) -> bool:
    """Whether a source has bytes beyond ``size``; readers that refuse such a range have none."""
    try:
        return any(len(piece) for piece in reader.read(key, size, 1))
    except (OSError, pa.ArrowException, ValueError):
        return False


class FileRanges:
    """Reads byte ranges below a root. Other sources only need the same ``read`` method."""

    def __init__(self, root_uri: str):
        self.root_uri = root_uri
        self._fs = None

    def __getstate__(self):
        return {"root_uri": self.root_uri, "_fs": None}

    def read(self, key: str, offset: int, length: int):
        """One response: yields the bytes of the range in pieces. It may end early, or raise OSError."""
        if self._fs is None:
            self._fs, self._path = open_root(self.root_uri)
        with self._fs.open_input_file(below(self._path, key)) as source:
            while length > 0:
                piece = source.read_at(min(PIECE, length), offset)
                if not piece:
                    return
                yield piece
                offset += len(piece)
                length -= len(piece)


def batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)
