"""One frozen object holds every path, database name, format and stream setting."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class LakeConfig:
    """Where the lake lives and how its tables are written.

    ``root`` is any path Spark can reach from all executors (object store, HDFS, shared mount).
    """

    root: str
    table_format: str = "parquet"  # or "delta" when its jar is on the classpath
    raw_folder: str = "bronze/raw"
    silver_db: str = "silver"
    gold_db: str = "gold"

    # Warehouse (JDBC) copy of the silver and gold tables; off while the URL is unset.
    jdbc_url: str | None = None
    jdbc_driver: str = "org.postgresql.Driver"
    jdbc_properties: dict[str, str] = field(default_factory=dict)
    jdbc_batch_rows: int = 10_000
    jdbc_connections: int = 16

    # Whether landed micro-batches are found by a manifest, which can be compacted, instead of by folder.
    use_manifest: bool = False

    # Hash partitions of a table that a change log is applied to; fixed for the life of the table.
    table_partitions: int = 64

    # Rows per output file; bounds file size whatever the partition size.
    max_records_per_file: int = 20_000_000

    # Of table files. Ids are hex text, which an entropy coder halves and Spark's default (snappy) leaves as it is.
    compression: str = "zstd"

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw(self) -> str:
        return self.path(self.raw_folder)

    @property
    def parsed_reviews(self) -> str:
        return self.path("silver", "reviews")

    @property
    def parsed_items(self) -> str:
        return self.path("silver", "metadata")

    @property
    def current_items(self) -> str:
        """Items as the change log has left them."""
        return self.path("silver", "current_items")

    @property
    def merge_data(self) -> str:
        return self.path("gold", "merge_data")

    @property
    def published(self) -> str:
        """The canonical table with each review once, which the silver and gold tables are built from."""
        return self.path("gold", "published")

    @property
    def decoded(self) -> str:
        """The landing job's micro-batch at work."""
        return self.path("gold", "decoded")

    def raw_table(self, table: str) -> str:
        return self.path("bronze", "tables", table)

    @property
    def streaming(self) -> str:
        return self.path("gold", "streaming")

    @property
    def manifest(self) -> str:
        return self.path("manifest", "landing")

    def slices(self, table: str) -> str:
        """Where the files that the manifest names are written."""
        return self.path("gold", "slices", table)

    @property
    def archive(self) -> str:
        return self.path("archive", "changes")

    def schemas(self, subject: str) -> str:
        return self.path("schemas", subject)

    def checkpoint(self, query: str) -> str:
        return self.path("checkpoints", query)

    def silver(self, table: str) -> str:
        return self.path("silver", table)

    def gold(self, table: str) -> str:
        return self.path("gold", table)


@dataclass(frozen=True)
class StreamConfig:
    """Settings of the change-stream jobs.

    ``state_buckets``, ``lanes`` and ``state_partitions`` are the state layout, which is fixed for the life of a checkpoint.
    To change it, count ``layout`` up and start the merge with the settings before as ``previous``.
    """

    source: str = "files"  # or "kafka" when its jar is on the classpath
    codec: str = "json"  # or "avro" when its jar is on the classpath
    bootstrap_servers: str = ""
    # Topic and table names of the change feed (fixed values).
    topic_prefix: str = "test"
    reviews_table: str = "public.raw_reviews"
    items_table: str = "public.raw_item_metadata"
    merged_topic: str = "merge_metadata_reviews"
    schema_id: int = 1
    trigger: str | None = "3 minutes"  # None: drain what is there, then stop
    max_offsets_per_trigger: int = 50_000_000
    # Offline feed: a micro-batch is bounded by files.
    max_files_per_trigger: int = 1_000
    # State is kept per bucket of products; a micro-batch brings each bucket its share of rows.
    state_buckets: int = 16_384
    # The reviews of a product are spread over this many buckets. Its items go to all of them, so the item stream and
    # its state are multiplied by it; a product's share of a task's work is divided by it.
    lanes: int = 8
    state_partitions: int = 200
    # Names the checkpoint that has this layout.
    layout: int = 0
    # Reviews, and item versions, of one bucket that a task holds in memory before it parks them in state.
    held_rows: int = 10_000
    # How long a review waits for its item, in milliseconds, before it goes to the rejected topic; None: for ever.
    state_ttl_ms: int | None = None
    # How long the landing job remembers a message, to leave out a copy of it ("2 hours"); None: copies land.
    dedup_window: str | None = None
    # What that time is measured by: "arrival" at the job, so that no message is ever late, or the message's own
    # "timestamp", for topics in which it only grows.
    dedup_clock: str = "arrival"
    # Records per file of the cold archive, and how its files are packed: one file is read by one task.
    archive_records_per_file: int = 100_000
    archive_compression: str = "gzip"

    @property
    def merge_query(self) -> str:
        return f"merge-{self.layout}" if self.layout else "merge"

    @property
    def rejected_topic(self) -> str:
        """Pairs that break the merged contract, with the reason."""
        return f"{self.merged_topic}.rejected"

    @property
    def reviews_topic(self) -> str:
        return f"{self.topic_prefix}.{self.reviews_table}"

    @property
    def items_topic(self) -> str:
        return f"{self.topic_prefix}.{self.items_table}"
