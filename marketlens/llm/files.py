"""Files of own formats in the folder that all machines share."""

from __future__ import annotations

from pyarrow import fs


def _locate(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def open_input(uri: str):
    """A file opened for one pass from its beginning."""
    system, path = _locate(uri)
    return system.open_input_stream(path, compression=None)


class OutputFile:
    """A file that gets its name only when it is whole."""

    def __init__(self, uri: str):
        self.system, self.path = _locate(uri)
        self.system.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.stream = self.system.open_output_stream(self.path + ".writing", compression=None)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def close(self) -> None:
        self.stream.close()
        self.system.move(self.path + ".writing", self.path)


def write_file(uri: str, data: bytes) -> None:
    out = OutputFile(uri)
    out.write(data)
    out.close()
