"""DataFrame-to-DataFrame analyses; none of them starts a job."""
