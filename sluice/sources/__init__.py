"""Readers and writers: format dispatch, batch publication, quarantine."""
