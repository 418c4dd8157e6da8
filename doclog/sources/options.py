"""Options of collections and logs: names, checks and addresses.

Option names are looked up without regard to case.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

# Options that must be given.
COLLECTION_OPTIONS = ("regionUrl", "fabric", "collection")
LOG_READ_OPTIONS = (
    "regionUrl",
    "fabric",
    "tenant",
    "stream",
    "replication",
    "subscriptionName",
)
LOG_WRITE_OPTIONS = LOG_READ_OPTIONS[:-1]

# Kinds of replication, and the bounds and default of batchSize.
REPLICATION = ("global", "local")
BATCH_SIZE_MIN, BATCH_SIZE_MAX, BATCH_SIZE_DEFAULT = 1, 10000, 100

# How many key folders a collection may have.
KEY_BUCKETS_MAX = 4096

DEFAULT_QUERY = "SELECT doc FROM {collection}"


class Options(Mapping[str, str]):
    """A read-only mapping of options; keys ignore case, values are texts."""

    def __init__(self, options: Mapping[str, object]):
        self._values = {
            str(k).lower(): v if isinstance(v, str) else str(v).lower()
            if isinstance(v, bool) else str(v)
            for k, v in options.items()
            if v is not None
        }

    def __getitem__(self, name: str) -> str:
        return self._values[name.lower()]

    def __iter__(self) -> Iterator[str]:
        return iter(self._values)

    def __len__(self) -> int:
        return len(self._values)

    def require(self, names: tuple[str, ...]) -> None:
        for name in names:
            if not self.get(name):
                raise ValueError(f"Option '{name}' is required")

    @property
    def root(self) -> str:
        """The address under which a region keeps its data."""
        return self["regionUrl"].rstrip("/")

    @property
    def query(self) -> str:
        return self.get("query") or DEFAULT_QUERY

    @property
    def batch_size(self) -> int:
        size = int(self.get("batchSize", str(BATCH_SIZE_DEFAULT)))
        if not BATCH_SIZE_MIN <= size <= BATCH_SIZE_MAX:
            raise ValueError(
                f"Batch size should be from {BATCH_SIZE_MIN} to {BATCH_SIZE_MAX}"
            )
        return size

    @property
    def key_buckets(self) -> int | None:
        """The number of key folders that a new collection gets; none if not given."""
        if self.get("keyBuckets") is None:
            return None
        buckets = int(self["keyBuckets"])
        if not 1 <= buckets <= KEY_BUCKETS_MAX:
            raise ValueError(f"keyBuckets should be from 1 to {KEY_BUCKETS_MAX}")
        return buckets

    @property
    def is_collection_stream(self) -> bool:
        return self.get("isCollectionStream", "false").lower() == "true"

    @property
    def replication(self) -> str:
        kind = self["replication"].lower()
        if kind not in REPLICATION:
            raise ValueError("The option replication takes local or global")
        if kind == "global" and self.is_collection_stream:
            raise ValueError(
                "A collection followed as a stream needs replication local"
            )
        return kind


def collection_options(options: Mapping[str, object]) -> Options:
    checked = Options(options)
    checked.require(COLLECTION_OPTIONS)
    return checked


def log_options(options: Mapping[str, object], *, write: bool = False) -> Options:
    checked = Options(options)
    checked.require(LOG_WRITE_OPTIONS if write else LOG_READ_OPTIONS)
    checked.replication  # noqa: B018 - raises on a bad value
    if write and checked.is_collection_stream:
        raise ValueError("A collection stream can only be read")
    return checked


def collection_path(options: Options, name: str | None = None) -> str:
    return f"{options.root}/fabric/{options['fabric']}/{name or options['collection']}"


def topic_address(options: Options) -> str:
    """The name of the topic: tenant, replication and fabric, then the stream.

    The scheme and the ``c8`` marks are fixed values of the address form.
    """
    kind = options.replication
    stream = options["stream"]
    if not options.is_collection_stream:
        stream = f"c8{kind}s.{stream}"
    return f"persistent://{options['tenant']}/c8{kind}.{options['fabric']}/{stream}"


def log_path(options: Options) -> str:
    """Where the messages of a topic lie: the parts of its address, as folders."""
    return f"{options.root}/{topic_address(options).removeprefix('persistent://')}"
