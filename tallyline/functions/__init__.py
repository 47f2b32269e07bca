"""Column functions: loosely typed JSON values and dates."""
