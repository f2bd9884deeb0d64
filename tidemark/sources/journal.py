"""What a task has sent, so that a task that runs again does not send it once more.

Spark runs a task again when its executor is lost. Its output is committed once, but a request is not
repeatable, so each small batch of attempts is written to the journal before it leaves the task. A task
that starts takes over what an earlier run of the same partition left, and sends only the rest; at most
the requests since the last batch are sent twice, and none of those reaches a table twice.

The folder has to be reachable from all executors, and belongs to one fetch: its requests must be the same
whenever a task runs. Requests that are equal in all of ``KEY`` are sent once.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs

KEY = ("source", "page_no", "http_method", "api_url", "input_value", "request_body")


def located(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder as Spark names it."""
    if folder.startswith(("/", "file:")):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


class Journal:
    """The journal of one task. Batches hold whole requests, all their attempts."""

    def __init__(self, folder: str, partition: int):
        files, root = located(folder)
        self.files, self.home = files, f"{root}/part={partition}"
        self.files.create_dir(self.home, recursive=True)
        self.done: set[tuple] = set()

    def kept(self) -> Iterator[pa.RecordBatch]:
        """What earlier runs have sent, a file at a time. Where two runs sent the same request, as with a
        speculative task, the first one found counts."""
        found = sorted(f.path for f in self.files.get_file_info(fs.FileSelector(self.home)) if f.path.endswith(".arrow"))
        for path in found:
            with self.files.open_input_file(path) as file, pa.ipc.open_file(file) as reader:
                for number in range(reader.num_record_batches):
                    batch = reader.get_batch(number)
                    keys = list(zip(*[batch.column(c).to_pylist() for c in KEY]))
                    fresh = [k not in self.done for k in keys]
                    self.done.update(keys)
                    yield batch.filter(pa.array(fresh, pa.bool_()))

    def has(self, request: dict) -> bool:
        """Whether the request is sent; from then on it counts as such."""
        key = tuple(request.get(c) for c in KEY)
        if key in self.done:
            return True
        self.done.add(key)
        return False

    def write(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """A file appears under its name only when it is complete."""
        name = f"{self.home}/{uuid4().hex}"
        with self.files.open_output_stream(f"{name}.tmp") as out, pa.ipc.new_file(out, batch.schema) as writer:
            writer.write_batch(batch)
        self.files.move(f"{name}.tmp", f"{name}.arrow")
        return batch
