"""Runnable jobs: each a function over a session and plain paths, a command line and a small configuration file."""
