"""Streaming: intentionally empty.

The reference starts no streaming query (no ``readStream``, ``writeStream``,
watermark or state); its one ``awaitAnyTermination`` call has nothing to await.
Incremental loads here are batch jobs driven by a business date
(``conformkit.plans.load``).  A user who wants them on a stream can call
``incremental_replace_files`` from ``foreachBatch``; nothing more is built.
"""
