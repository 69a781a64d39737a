"""Folders of tables of which one is current, switched in one step.

Every build writes a folder of its own. A manifest, a file with a number for its name and the folder's name
for its content, makes it current when it gets its name, which is one rename; the highest number is the
current one. A reader sees the tables of one build, before, during and after another that may fail. Older folders stay
for readers that have begun with them, as many as ``keep`` says.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from skyfare.sources import files

MANIFESTS = "_versions"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n) for n in files.names(spark, f"{root}/{MANIFESTS}") if n.isdigit())


def folder_of(spark: SparkSession, root: str, number: int) -> str:
    return f"{root}/{files.first_line(spark, f'{root}/{MANIFESTS}/{number:010d}')}"


def current(spark: SparkSession, root: str) -> str | None:
    """The current folder, or None before the first build is published."""
    numbers = _numbers(spark, root)
    return folder_of(spark, root, numbers[-1]) if numbers else None


def new_folder(root: str) -> str:
    """Where to write a build that is not current yet."""
    return f"{root}/version-{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, folder: str, keep: int = 2) -> int:
    """Makes a written folder of ``new_folder`` the current one, and removes all but the last ``keep``."""
    name = folder.rsplit("/", 1)[1]
    waiting = f"{root}/{MANIFESTS}/.{name}"
    files.put(spark, waiting, name)
    number = (_numbers(spark, root) or [0])[-1] + 1
    while not files.renamed(spark, waiting, f"{root}/{MANIFESTS}/{number:010d}"):
        number += 1  # another build was faster
    for old in _numbers(spark, root)[:-keep]:
        folder = folder_of(spark, root, old)
        files.remove(spark, f"{root}/{MANIFESTS}/{old:010d}")
        files.remove(spark, folder)
    return number
