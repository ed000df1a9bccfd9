"""Where a dataset's layers and dated snapshots live."""

import datetime as dt
from dataclasses import dataclass

from tierlake.schemas import DATE_COLUMN


@dataclass(frozen=True)
class Layout:
    """Roots of the layers of one dataset.

    ``root`` is any URI Spark can read. With one bucket per layer, give the bare
    scheme: ``Layout("s3a://", "items")`` has its bronze at ``s3a://bronze/items``.
    """

    root: str
    dataset: str
    gold_dataset: str | None = None
    bronze_bucket: str = "bronze"
    silver_bucket: str = "silver"
    gold_bucket: str = "gold"

    def _layer(self, bucket, dataset):
        base = self.root if self.root.endswith("/") else self.root + "/"
        return f"{base}{bucket}/{dataset}"

    @property
    def bronze(self):
        return self._layer(self.bronze_bucket, self.dataset)

    @property
    def meta(self):
        return self._layer(self.bronze_bucket, f"{self.dataset}_meta")

    @property
    def silver(self):
        return self._layer(self.silver_bucket, self.dataset)

    @property
    def gold(self):
        return self._layer(self.gold_bucket, self.gold_dataset or f"{self.dataset}_agg")


def snapshot_path(layer_root, date):
    """Folder of one dated snapshot; rejects what is not an ISO date."""
    return f"{layer_root}/{DATE_COLUMN}={as_date(date).isoformat()}"


def as_date(date):
    return dt.date.fromisoformat(date) if isinstance(date, str) else date


def today_utc():
    """The snapshot date of a run that is given none."""
    return dt.datetime.now(dt.timezone.utc).date().isoformat()
