"""Replacing the snapshot of a date in one step, on any Hadoop file system."""

import logging
import uuid
from contextlib import contextmanager

from tierlake.layout import as_date, snapshot_path

log = logging.getLogger(__name__)

# Names with a leading underscore and no "=" are hidden from Spark's readers.
STAGED = "_staged-"
FORMER = "_former-"


class Folders:
    """The file system of a layer."""

    def __init__(self, spark, root):
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.files = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name):
        return self.hadoop.Path(name)

    def exists(self, name):
        return self.files.exists(self.path(name))

    def rename(self, source, target):
        if not self.files.rename(self.path(source), self.path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def delete(self, name):
        return self.files.delete(self.path(name), True)

    def names(self, root):
        """Names in a folder; none if it does not exist."""
        path = self.path(root)
        if not self.files.exists(path):
            return []
        return [status.getPath().getName() for status in self.files.listStatus(path)]


@contextmanager
def staged(spark, root):
    """A new folder beside the snapshots of a layer, deleted at the end of the block.

    Nothing that fails in the block touches a snapshot.
    """
    folder = f"{root}/{STAGED}{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        Folders(spark, root).delete(folder)


def publish(spark, folder, root, date):
    """Make ``folder``, written in full, the snapshot ``date`` of the layer at ``root``.

    The former snapshot is moved aside, the new one into its place, and the former is then
    deleted. Each move is one rename, which HDFS and local file systems do as a whole; an
    object store copies instead, and needs a committer or a table format for more. If the run
    ends between the moves, :func:`recover` puts the former snapshot back.
    """
    files, target = Folders(spark, root), snapshot_path(root, date)
    recover(spark, root, date)
    former = f"{root}/{FORMER}{as_date(date).isoformat()}-{uuid.uuid4().hex}"
    replaces = files.exists(target)
    if replaces:
        files.rename(target, former)
    try:
        files.rename(folder, target)
    except Exception:
        if replaces:
            files.rename(former, target)
        raise
    if replaces:
        files.delete(former)


def recover(spark, root, date=None):
    """Undo what a run left half-way that ended while it published; returns the dates put back.

    A snapshot that was moved aside and has no successor goes back to its place; one that has
    a successor is deleted. Every write of a date begins with this, for that date.
    """
    files, back = Folders(spark, root), []
    prefix = FORMER if date is None else f"{FORMER}{as_date(date).isoformat()}-"
    for name in files.names(root):
        if not name.startswith(prefix):
            continue
        moved = name.removeprefix(FORMER).rpartition("-")[0]
        if files.exists(snapshot_path(root, moved)):
            files.delete(f"{root}/{name}")
        else:
            files.rename(f"{root}/{name}", snapshot_path(root, moved))
            back.append(moved)
            log.warning("%s: snapshot %s put back", root, moved)
    return back


def discard_staged(spark, root):
    """Delete what runs that were killed have left staged; only while no other run writes here."""
    files = Folders(spark, root)
    for name in files.names(root):
        if name.startswith(STAGED):
            files.delete(f"{root}/{name}")
