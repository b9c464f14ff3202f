"""Errors a job raises for reasons its owner can fix."""


class JobError(ValueError):
    """The job description does not fit the data it names."""


class LsnRangeError(JobError):
    """The end of a change range lies before its start."""


class StuckWatermarkError(JobError):
    """A limited pull returned a full batch but the watermark did not move."""


class BatchError(JobError):
    """Some jobs of a batch failed. ``results`` holds those of the jobs that did not, ``failures`` an error for each other output."""

    def __init__(self, results: list, failures: dict[str, Exception]):
        told = "; ".join(f'"{output}": {error}' for output, error in failures.items())
        super().__init__(f"{len(failures)} of {len(results) + len(failures)} jobs failed: {told}")
        self.results, self.failures = results, failures
