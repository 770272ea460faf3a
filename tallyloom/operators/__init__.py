"""DataFrame -> DataFrame steps. None of them starts a job unless its description says so."""
