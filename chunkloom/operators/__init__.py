"""DataFrame operators; all lazy unless their docstring says that they run a job."""
