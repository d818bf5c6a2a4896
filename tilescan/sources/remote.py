"""Scenes from a remote processing service: jobs found or submitted, awaited, downloaded, unpacked.

The service is a plug-in (``Service``); none is built in.  Granules are worked on by ``run``, each by itself: one that fails has
its error in the result, and the others go on.
"""

from __future__ import annotations

import io
import logging
import netrc
import os
import random
import time
import uuid
import zipfile
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any, Protocol, TypeVar

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilescan.config import JOB_PARAMETERS
from tilescan.functions.workers import ship
from tilescan.sources import raster

Made = TypeVar("Made")
# fixed values: answers of a server after which a call is made again
RETRIED = (429, 500, 502, 503, 504)
RESULT = "granule string, job_id string, path string, status string, error string"
failed_jobs = logging.getLogger("failed_jobs")


class NoCoverage(Exception):
    """The service cannot process a granule, as no elevation model covers it."""


class Unavailable(Exception):
    """A call that may be made again; ``status`` is the server's answer."""

    def __init__(self, status: int, message: str = ""):
        super().__init__(message or f"status {status}")
        self.status = status


class Job(Protocol):
    job_id: str
    granules: list[str]
    params: Mapping[str, Any]
    failed: bool
    expired: bool
    complete: bool
    succeeded: bool


class Service(Protocol):
    """What a plug-in has to offer."""

    def jobs(self) -> list[Job]: ...

    def submit(self, granule: str, name: str, params: Mapping[str, Any]) -> Job: ...

    def refreshed(self, job: Job) -> Job: ...

    def archives(self, job: Job) -> list[tuple[str, bytes]]: ...

    def credits(self) -> float | None: ...

    def costs(self) -> Mapping[str, Any]: ...


@dataclass(frozen=True)
class Retry:
    """How often and how patiently calls are repeated, and how many connections a client may hold."""

    times: int = 32
    backoff: float = 2.0
    longest: float = 120.0
    connections: int = 64

    def call(self, f: Callable[[], Made], sleep: Callable[[float], None] = time.sleep) -> Made:
        for k in range(self.times + 1):
            try:
                return f()
            except Unavailable as failure:
                if failure.status not in RETRIED or k == self.times:
                    raise
                sleep(min(self.longest, self.backoff * 2 ** max(0, k - 1)) * random.uniform(0.5, 1.0) if k else 0.0)
        raise AssertionError


def credentials(username: str | None, password: str | None, host: str, netrc_file: str | None = None, ask: Callable[[str], str] | None = None) -> tuple[str, str]:
    """Name and password: those given, else the host's of the .netrc file, else asked for; an error if there is nobody to ask."""
    if username and password:
        return username, password
    try:
        found = netrc.netrc(netrc_file or os.path.expanduser("~/.netrc")).authenticators(host)
    except (OSError, netrc.NetrcParseError):
        found = None
    if found and found[0] and found[2]:
        return found[0], found[2]
    if ask is None:
        raise ValueError(f"no credentials for {host}")
    return username or ask("username"), password or ask("password")


def default_parameters() -> dict[str, Any]:
    return dict(JOB_PARAMETERS)


def matches(job: Job, granule: str, wanted: Mapping[str, Any]) -> bool:
    return list(job.granules) == [granule] and not job.failed and not job.expired and all(k in job.params and job.params[k] == v for k, v in wanted.items())


def catalogue(spark: SparkSession, service: Service) -> DataFrame:
    """The service's jobs as a table, in its order (``job_id``), listed once for all granules.  Parameters are texts."""
    rows = [(k, j.job_id, j.granules[0] if len(j.granules) == 1 else None, bool(j.failed), bool(j.expired), {a: text(b) for a, b in j.params.items()}) for k, j in enumerate(service.jobs())]
    return spark.createDataFrame(rows, "job_id long, name string, granule string, failed boolean, expired boolean, params map<string,string>")


def text(value: Any) -> str | None:
    return None if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def got_or_submitted(service: Service, granule: str, wanted: Mapping[str, Any] | None = None, retry: Retry = Retry(), listed: list[Job] | None = None) -> Job | None:
    """The first matching job, else a new one named after the granule's last eight letters; none where there is no coverage."""
    wanted = default_parameters() if wanted is None else wanted
    for job in retry.call(service.jobs) if listed is None else listed:
        if matches(job, granule, wanted):
            return job
    try:
        return retry.call(lambda: service.submit(granule, f"RTC_{granule[-8:]}", wanted))
    except NoCoverage as failure:
        failed_jobs.error("%s: %s", granule, failure)
        return None


def awaited(service: Service, job: Job, timeout: float = 3600, interval: float = 60, retry: Retry = Retry(), clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> Job | None:
    """The job once it is complete; none after ``timeout`` seconds."""
    end = clock() + timeout
    while not job.complete:
        if clock() >= end:
            logging.error("job %s: no result in %s s", job.job_id, timeout)
            return None
        sleep(interval)
        job = retry.call(lambda held=job: service.refreshed(held))
    return job


def is_wanted(name: str) -> bool:
    low = name.lower()
    return low.endswith("_vv.tif") or low.endswith(".png") and "rgb" not in low


def new_name(name: str, granule: str) -> str:
    base = name.rsplit("/", 1)[-1]
    ending = os.path.splitext(base)[1]
    return granule + ending if ending.lower() == ".tif" else f"{granule}_browse{ending}" if ending.lower() == ".png" else base


def unpacked(archive: bytes, granule: str, folder: str) -> list[str]:
    """The wanted members of a zip archive, written to ``folder``/tif or ``folder``/png under their new names, each in its place
    only once it is whole.  Only a lower-case .tif goes to the first."""
    fs, top = raster.store(folder)
    out = []
    with zipfile.ZipFile(io.BytesIO(archive)) as z:
        for member in z.namelist():
            if not is_wanted(member):
                continue
            place = f"{top}/{'tif' if member.endswith('.tif') else 'png'}"
            fs.create_dir(place, recursive=True)
            held = f"{place}/.{uuid.uuid4().hex}"
            with z.open(member) as source, fs.open_output_stream(held) as target:
                while part := source.read(1 << 22):
                    target.write(part)
            fs.move(held, f"{place}/{new_name(member, granule)}")
            out.append(f"{place}/{new_name(member, granule)}")
    return out


def downloaded(service: Service, job: Job, folder: str, temp: str | None = None, keep_zip: bool = False, retry: Retry = Retry()) -> list[str]:
    """The files of a finished job; if its raster is there already, that one and no download."""
    granule = job.granules[0]
    fs, top = raster.store(folder)
    there = f"{top}/tif/{granule}.tif"
    if fs.get_file_info(there).is_file:
        return [there]
    out = []
    for name, data in retry.call(lambda: service.archives(job)):
        if keep_zip and temp:
            zfs, ztop = raster.store(temp)
            zfs.create_dir(ztop, recursive=True)
            with zfs.open_output_stream(f"{ztop}/{name}") as f:
                f.write(data)
        if name.lower().endswith(".zip"):
            out += unpacked(data, granule, folder)
    return out


def first_raster(paths: list[str]) -> str | None:
    return next((p for p in paths if p.lower().endswith(".tif")), None)


def fetched(service: Service, granule: str, folder: str, temp: str | None = None, keep_zip: bool = False, wanted: Mapping[str, Any] | None = None, retry: Retry = Retry(), listed: list[Job] | None = None, **wait: Any) -> dict[str, str | None]:
    """One granule from request to raster; a row of RESULT that tells what came of it."""
    row: dict[str, str | None] = {"granule": granule, "job_id": None, "path": None, "status": "failed", "error": None}
    try:
        job = got_or_submitted(service, granule, wanted, retry, listed)
        if job is None:
            return row | {"status": "no coverage"}
        row["job_id"] = str(job.job_id)
        done = awaited(service, job, retry=retry, **wait)
        if done is None:
            return row | {"status": "timeout"}
        if not done.succeeded:
            return row | {"error": "the job failed"}
        found = first_raster(downloaded(service, done, folder, temp, keep_zip, retry))
        return row | ({"path": found, "status": "done"} if found else {"error": "no raster in the archives"})
    except Exception as failure:  # noqa: BLE001
        failed_jobs.error("%s: %s", granule, failure)
        return row | {"error": str(failure)}


def run(spark: SparkSession, granules: list[str], service: Callable[[], Service], folder: str, parallel: int = 32, **how: Any) -> DataFrame:
    """RESULT for each granule.  ``service`` makes a client in each task; ``parallel`` tasks at most work at once.

    Evaluating the result does the work: write it before it is used twice.  A granule that is done again finds its job and
    its raster, so tasks may be repeated.
    """
    rows = spark.createDataFrame([(g,) for g in dict.fromkeys(granules)], "granule string")

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = listed = None
        for frame in frames:
            client = client or service()
            listed = Retry().call(client.jobs) if listed is None else listed
            for granule in frame["granule"]:
                yield pd.DataFrame([fetched(client, granule, folder, listed=listed, **how)])

    ship(spark)
    return rows.repartition(max(1, min(parallel, len(granules))), "granule").mapInPandas(walk, RESULT)


def failures(result: DataFrame) -> DataFrame:
    """granule, status and error of those that are not done."""
    return result.where("status <> 'done'").select("granule", "status", "error")
