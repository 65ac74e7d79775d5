"""Identity hashes."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F


def ticket_identity(source_system: Column, ticket_id: Column) -> Column:
    """The text that identifies a ticket inside a run; cheaper to shuffle than its hash."""
    return F.concat_ws(":", source_system, ticket_id)


def ticket_key(source_system: Column, ticket_id: Column) -> Column:
    return F.sha2(ticket_identity(source_system, ticket_id), 256)


def run_key(input_hash: Column, config_hash: Column, dry_run: Column, incremental: Column) -> Column:
    flags = [F.coalesce(f, F.lit(False)).cast("int").cast("string") for f in (dry_run, incremental)]
    return F.sha2(F.concat_ws(":", input_hash, config_hash, *flags), 256)


def run_key_of(input_hash: str, config_hash: str, dry_run: bool, incremental: bool) -> str:
    """The same key for the one run that the driver is about to start."""
    identity = f"{input_hash}:{config_hash}:{int(dry_run)}:{int(incremental)}"
    return hashlib.sha256(identity.encode()).hexdigest()
