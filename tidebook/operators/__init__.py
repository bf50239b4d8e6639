"""DataFrame-to-DataFrame operators; none of them keeps session state."""
