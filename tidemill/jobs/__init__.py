from tidemill.jobs.cli import main

__all__ = ["main"]
