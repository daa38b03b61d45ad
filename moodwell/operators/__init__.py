"""DataFrame operators; lazy unless their name says write or run."""
