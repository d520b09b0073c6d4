"""Readers and writers: feeds, snapshots, history, context, replies, digests."""
