"""Streaming runs: starting queries, sinks written once per batch, replays of stored ads."""
