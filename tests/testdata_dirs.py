"""Folders of the driver's test tables, under a module name no other folder of tests has."""

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
