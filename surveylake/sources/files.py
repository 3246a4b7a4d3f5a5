"""Opening single files from inside a task."""

from __future__ import annotations

from pyarrow import fs


def open_in_place(path: str):
    """A seekable stream on a file of the cluster's storage."""
    filesystem, name = fs.FileSystem.from_uri(_known_scheme(path))
    return filesystem.open_input_file(name)


def open_for_writing(path: str):
    """A stream that creates or replaces a file of the cluster's storage, with its folder."""
    filesystem, name = fs.FileSystem.from_uri(_known_scheme(path))
    filesystem.create_dir(name.rsplit("/", 1)[0], recursive=True)
    return filesystem.open_output_stream(name, compression=None)


def can_open_in_place(root: str) -> bool:
    """Whether tasks can open files below `root` themselves; Spark's own readers reach more file systems."""
    try:
        fs.FileSystem.from_uri(_known_scheme(root))
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


def decode_lines(raw: bytes) -> str:
    """Text of whole lines with plain newlines; undecodable bytes are replaced, as Spark's readers do."""
    return raw.replace(b"\r\n", b"\n").removesuffix(b"\r").decode("utf-8", errors="replace")


def _known_scheme(path: str) -> str:
    scheme, colon, rest = path.partition("://")
    return f"s3://{rest}" if colon and scheme in ("s3a", "s3n") else path
