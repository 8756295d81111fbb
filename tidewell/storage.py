"""Tables' files through Hadoop's file systems: the driver lists, deletes and commits; executors write data."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tidewell.errors import BadInputError, IoError

#: Deletes that are under way at a time.
PARALLEL = 10

# URL schemes and the prefix of the environment's keys for them.
ENV_PREFIXES = {"s3": "AWS_", "s3a": "AWS_", "gs": "GOOGLE_", "az": "AZURE_", "adl": "AZURE_", "azure": "AZURE_", "abfs": "AZURE_", "abfss": "AZURE_"}
# Settings of Hadoop's file systems for keys of the environment.
_S3_SETTINGS = {"aws_access_key_id": "fs.s3a.access.key", "aws_secret_access_key": "fs.s3a.secret.key", "aws_session_token": "fs.s3a.session.token", "aws_endpoint": "fs.s3a.endpoint", "aws_endpoint_url": "fs.s3a.endpoint", "aws_region": "fs.s3a.endpoint.region"}


def check_url(url: str) -> str:
    """The URL without slashes at its end. A bare path has no scheme and isn't one."""
    if not urlsplit(url).scheme:
        raise BadInputError(f"{url} is no URL: give file:// and an absolute path for a local one")
    return url.rstrip("/")


def table_name(url: str) -> str:
    return unquote(check_url(url).rpartition("/")[2])


def env_options(url: str, env: Mapping[str, str] = os.environ) -> dict[str, str]:
    """The environment's keys for the URL's scheme, in lower case, with their values."""
    prefix = ENV_PREFIXES.get(urlsplit(url).scheme)
    return {k.lower(): v for k, v in env.items() if prefix and k.startswith(prefix)}


_GOOGLE_KEYFILES = ("google_application_credentials", "google_service_account_path", "google_service_account")
_S3_CLASS = "org.apache.hadoop.fs.s3a.S3AFileSystem"
_TOKEN_PROVIDER = "org.apache.hadoop.fs.azurebfs.oauth2.ClientCredsTokenProvider"
#: Asks Hadoop's S3 file system to create a file by a conditional write.
_CONDITIONAL = "fs.option.create.conditional.overwrite"


def hadoop_settings(options: Mapping[str, str]) -> dict[str, str]:
    """Settings of Hadoop's S3, Google and Azure file systems; s3: is read by that of s3a:."""
    found = {_S3_SETTINGS[k]: v for k, v in options.items() if k in _S3_SETTINGS}
    if found.get("fs.s3a.endpoint", "").startswith("http://"):
        found |= {"fs.s3a.connection.ssl.enabled": "false", "fs.s3a.path.style.access": "true"}
    for key in _GOOGLE_KEYFILES:
        if key in options:
            return found | {"fs.gs.auth.type": "SERVICE_ACCOUNT_JSON_KEYFILE", "fs.gs.auth.service.account.json.keyfile": options[key]}
    azure = {k.removeprefix("azure_").removeprefix("storage_"): v for k, v in options.items() if k.startswith("azure_")}
    host = f"{azure['account_name']}.dfs.core.windows.net" if "account_name" in azure else None
    if host and "account_key" in azure:
        found[f"fs.azure.account.key.{host}"] = azure["account_key"]
    elif host and "sas_token" in azure:
        found |= {f"fs.azure.account.auth.type.{host}": "SAS", f"fs.azure.sas.fixed.token.{host}": azure["sas_token"].removeprefix("?")}
    elif host and {"client_id", "client_secret", "tenant_id"} <= azure.keys():
        end = f"https://login.microsoftonline.com/{azure['tenant_id']}/oauth2/token"
        found |= {f"fs.azure.account.auth.type.{host}": "OAuth", f"fs.azure.account.oauth.provider.type.{host}": _TOKEN_PROVIDER, f"fs.azure.account.oauth2.client.id.{host}": azure["client_id"], f"fs.azure.account.oauth2.client.secret.{host}": azure["client_secret"], f"fs.azure.account.oauth2.client.endpoint.{host}": end}
    return found


@dataclass(frozen=True)
class Entry:
    """A file below a table's folder: its path from there, and size."""

    path: str
    size: int


class Store:
    """A folder at a URL."""

    def __init__(self, spark: SparkSession, url: str) -> None:
        self.spark, self.url = spark, check_url(url)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for key, value in hadoop_settings(env_options(url)).items():
            conf.set(key, value)
        if urlsplit(url).scheme == "s3" and conf.get("fs.s3.impl") is None:
            conf.set("fs.s3.impl", _S3_CLASS)
        self._path = jvm.org.apache.hadoop.fs.Path
        self.root = self._path(self.url)
        try:
            self.fs = self.root.getFileSystem(conf)
        except Py4JJavaError as e:
            raise IoError(f"{url}: {e.java_exception.getMessage()}") from e
        if hasattr(self.fs, "setWriteChecksum"):
            self.fs.setWriteChecksum(False)

    def path(self, name: str):
        return self._path(f"{self.url}/{name}" if name else self.url)

    def full(self, name: str) -> str:
        return f"{self.url}/{name}"

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self.path(name))

    def any(self) -> bool:
        """Whether any file is there; the first one found answers."""
        return self.exists() and self.fs.listFiles(self.root, True).hasNext()

    def tail(self, name: str, size: int, n: int) -> bytes:
        """The last n bytes of a file of the given size."""
        stream = self.fs.open(self.path(name))
        try:
            stream.seek(max(0, size - n))
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def files(self, name: str = "", hidden: bool = False) -> list[Entry]:
        """All files below name, sorted; without checksum files and, unless asked for, what a dot or underscore marks as Spark's."""
        if not self.exists(name):
            return []
        base = self.fs.makeQualified(self.root).toUri().getPath().rstrip("/") + "/"
        out, found = [], self.fs.listFiles(self.path(name), True)
        while found.hasNext():
            status = found.next()
            path = status.getPath().toUri().getPath().removeprefix(base)
            last = path.rpartition("/")[2]
            if not (last.startswith(".") and last.endswith(".crc")) and (hidden or not last.startswith(("_SUCCESS", "."))):
                out.append(Entry(path, status.getLen()))
        return sorted(out, key=lambda e: e.path)

    def read(self, name: str) -> bytes:
        try:
            stream = self.fs.open(self.path(name))
        except Py4JJavaError as e:
            raise IoError(f"{self.full(name)}: {e.java_exception.getMessage()}") from e
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, name: str, data: bytes) -> None:
        """Writes or replaces a file."""
        self._write(name, data, True)

    def create(self, name: str, data: bytes) -> bool:
        """Writes a file that isn't there yet; False if another's is. Of several writers one succeeds, and its file is whole.

        Where the call fails, the file that is there decides: a write that was reported as failed may have been done.
        """
        if urlsplit(self.url).scheme == "file":
            return self._link(name, data)
        try:
            self._write(name, data, False)
        except Py4JJavaError:
            if not self.exists(name):
                raise
            return self.read(name) == data
        return True

    def _write(self, name: str, data: bytes, over: bool) -> None:
        """S3 has no exclusive creation but by a conditional write, which is asked for and must be there."""
        if not over and urlsplit(self.url).scheme in ("s3", "s3a"):
            stream = self.fs.createFile(self.path(name)).overwrite(False).must(_CONDITIONAL, True).build()
        else:
            stream = self.fs.create(self.path(name), over)
        try:
            stream.write(data)
        finally:
            stream.close()

    def _link(self, name: str, data: bytes) -> bool:
        """On a local disk a file becomes visible when it is whole: a link can't replace another file."""
        target = self.path(name).toUri().getPath()
        os.makedirs(os.path.dirname(target), exist_ok=True)
        handle, own = tempfile.mkstemp(prefix=f".{uuid.uuid4().hex}", dir=os.path.dirname(target))
        try:
            with os.fdopen(handle, "wb") as file:
                file.write(data)
            os.chmod(own, 0o644)
            os.link(own, target)
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
        return True

    def delete(self, name: str = "") -> None:
        self.fs.delete(self.path(name), True)

    def delete_files(self, names: list[str]) -> None:
        with ThreadPoolExecutor(PARALLEL) as pool:
            list(pool.map(lambda n: self.fs.delete(self.path(n), False), names))


def scratch_url(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: in spark.checkpoint.dir. A local master without one (tests) gets a temporary one.

    A path without a scheme means the default file system. On a cluster the setting is needed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise BadInputError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='tidewell-')}"
    if not urlsplit(root).scheme:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if root.startswith("file:"):
        root = "file:///" + root.removeprefix("file:").lstrip("/")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
