"""spark-submit entry point: spark-submit --py-files canvass.zip run_job.py ARGS."""

from canvass.job import main

if __name__ == "__main__":
    raise SystemExit(main())
