"""DataFrame-to-DataFrame operators; none of them runs a job on data-sized results."""
