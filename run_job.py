"""Entry point for spark-submit; see tidemill/jobs/cli.py."""

from tidemill.jobs import main

if __name__ == "__main__":
    main()
