"""Payloads posted once from a stream, whatever is tried again.

Spark hands a batch to the sink again where a run ended before the batch was noted as done. Each task notes the key of a
payload, with the service's answer, in the batch's ledger as soon as it is sent; keys that the ledger holds are not sent
again. The ledger is cut in BUCKETS by key, and rows are dealt alike, so a task reads what its own keys need. Between a
post and its note a lost task leaves a gap of one payload: such a payload goes out again under the same key, by which the
service can tell. Ledgers of batches before the last one go, since Spark never hands those out again; their answers stay
in the table of answers. Connection errors are tried again after a pause; any other error is the payload's answer.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklane.sources import stores

BUCKETS, TRIES, PAUSE = 64, 3, 5.0
ANSWERS = "key string, ok boolean, error string"


def _noted(ledger: str, bucket: int) -> dict[str, dict]:
    """What tasks before this one have noted for a bucket; a line that was cut off is none."""
    found: dict[str, dict] = {}
    folder = f"{ledger}/{bucket}"
    for f in stores.files_below(folder) if stores.exists(folder) else []:
        for line in b"".join(stores.read_range(f, 0, 1 << 62)).decode().split("\n"):
            if line.endswith("}"):
                answer = json.loads(line)
                found[answer["key"]] = answer
    return found


def _sent(send: Callable[[str, str], None], key: str, payload: str, tries: int, pause: float) -> dict:
    """The answer for a payload; a connection that stays broken ends the task, and the batch is tried again."""
    for left in reversed(range(tries)):
        try:
            send(key, payload)
            return {"key": key, "ok": True, "error": None}
        except ConnectionError:
            if not left:
                raise
            time.sleep(pause)
        except Exception as e:  # noqa: BLE001  the service's own no to one payload
            return {"key": key, "ok": False, "error": str(e) or type(e).__name__}
    raise ValueError("tries is 1 or more")


class Inbox:
    """A file-backed service: JSON lines (key, payload) below `folder`, a file for each task that posts, not for each payload.

    A payload is out once its line is flushed. A task gets a copy of its own, which opens its file with the first payload.
    """

    def __init__(self, folder: str):
        self.folder, self.out = folder.rstrip("/"), None

    def __call__(self, key: str, payload: str) -> None:
        if self.out is None:
            store, path = stores.opened(self.folder)
            store.create_dir(path, recursive=True)
            self.out = store.open_output_stream(f"{path}/{uuid.uuid4().hex}")
        self.out.write(f"{json.dumps({'key': key, 'payload': payload})}\n".encode())
        self.out.flush()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def post_batch(rows: DataFrame, batch: int, folder: str, send: Callable[[str, str], None], tries: int = TRIES, pause: float = PAUSE, close: Callable[[], None] | None = None) -> None:
    """For foreachBatch: send each (key, payload) of the batch once; answers (key, ok, error) go to `folder`/answers/batch=N.

    Each task calls `close`, if given, at its end, for what `send` keeps open from payload to payload.
    """
    folder = folder.rstrip("/")
    ledger = f"{folder}/ledger/{batch}"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, dict[str, dict]] = {}
        notes: dict[int, object] = {}
        try:
            for part in parts:
                answers = []
                for bucket, key, payload in part.itertuples(index=False):
                    if bucket not in known:
                        known[bucket] = _noted(ledger, bucket)
                        store, path = stores.opened(f"{ledger}/{bucket}")
                        store.create_dir(path, recursive=True)
                        notes[bucket] = store.open_output_stream(f"{path}/{uuid.uuid4().hex}")
                    if key not in known[bucket]:
                        known[bucket][key] = _sent(send, key, payload, tries, pause)
                        notes[bucket].write(f"{json.dumps(known[bucket][key])}\n".encode())
                        notes[bucket].flush()
                    answers.append(known[bucket][key])
                yield pd.DataFrame(answers, columns=["key", "ok", "error"])
        finally:
            for n in notes.values():
                n.close()
            if close is not None:
                close()

    bucket = F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int").alias("bucket")
    dealt = rows.select(bucket, F.col("key").cast("string").alias("key"), F.col("payload").cast("string").alias("payload")).repartition(BUCKETS, "bucket")
    dealt.mapInPandas(run, ANSWERS).write.mode("overwrite").parquet(f"{folder}/answers/batch={batch}")
    store, path = stores.opened(f"{folder}/ledger/{batch - 2}")
    if stores.exists(f"{folder}/ledger/{batch - 2}"):
        store.delete_dir(path)
