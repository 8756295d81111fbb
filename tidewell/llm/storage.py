"""Files in the shared folder, written and read by Python workers through Arrow's file systems."""

from __future__ import annotations

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path of a URI; file: may have any number of slashes. Hadoop's s3a: and s3n: are Arrow's s3:.

    Arrow takes keys, region and endpoint of S3 from the AWS_ variables or the machine's role.
    """
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3" + uri[3:]
    return fs.FileSystem.from_uri(uri)


def create(uri: str):
    """A stream to a new file; its folder is made. Names are unique to an attempt, so that no other attempt writes there."""
    system, path = resolve(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str):
    system, path = resolve(uri)
    return system.open_input_file(path)


def remove(uri: str) -> None:
    system, path = resolve(uri)
    system.delete_file(path)
