"""The job: extract of one or more leagues, and the pitch fact derived from it."""
